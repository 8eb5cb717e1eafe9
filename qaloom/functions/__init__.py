"""qaloom.functions"""
