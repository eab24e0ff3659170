"""prairie: a PySpark-native library of relational, text, graph and model operators."""
