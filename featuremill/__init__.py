"""featuremill: marketplace feature tables as Spark DataFrame plans."""
