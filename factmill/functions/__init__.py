"""factmill.functions"""
