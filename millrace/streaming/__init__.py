"""millrace.streaming"""
