"""tessera.sources"""
