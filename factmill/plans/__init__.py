"""factmill.plans"""
