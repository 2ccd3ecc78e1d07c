"""featherline.functions"""
