"""featherline.plans"""
