"""lumenfold.operators"""
