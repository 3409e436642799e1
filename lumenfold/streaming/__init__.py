"""lumenfold.streaming"""
