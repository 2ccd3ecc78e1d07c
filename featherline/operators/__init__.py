"""featherline.operators"""
