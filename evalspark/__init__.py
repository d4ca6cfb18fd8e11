"""A PySpark-native analytics engine for collections of structured review documents."""
