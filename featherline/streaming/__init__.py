"""featherline.streaming"""
