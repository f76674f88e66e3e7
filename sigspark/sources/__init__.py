"""sigspark.sources"""
