"""sigspark.functions"""
