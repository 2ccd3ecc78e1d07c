"""featherline.sources"""
