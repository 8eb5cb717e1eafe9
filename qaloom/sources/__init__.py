"""qaloom.sources"""
