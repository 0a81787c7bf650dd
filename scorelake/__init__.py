"""scorelake: layered analytics over nested event documents, written for Spark."""
