"""docloom: semantic-document analytics expressed as Spark DataFrame plans."""
