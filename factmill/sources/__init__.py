"""factmill.sources"""
