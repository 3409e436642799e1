"""lumenfold.plans"""
