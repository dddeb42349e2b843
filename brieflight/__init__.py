"""brieflight: a PySpark-native engine for collections of legal documents and their catalogue metadata."""
