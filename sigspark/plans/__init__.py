"""sigspark.plans"""
