"""sigspark.streaming"""
