"""factmill.operators"""
