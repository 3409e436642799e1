"""lumenfold.functions"""
