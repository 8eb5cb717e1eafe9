"""qaloom.streaming"""
