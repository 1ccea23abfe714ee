"""Discovery and verification of web sites with public comments, on Spark."""
