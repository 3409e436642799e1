"""lumenfold.sources"""
