"""qaloom.operators"""
