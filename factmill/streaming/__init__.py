"""factmill.streaming"""
