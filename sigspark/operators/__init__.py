"""sigspark.operators"""
