"""taxaflow: amplicon-sequencing analytics expressed as Spark DataFrame plans."""
