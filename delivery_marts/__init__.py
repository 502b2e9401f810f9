"""Order-and-delivery normalisation, validation and data marts as Spark plans."""
