"""lakevault: a retail lakehouse on Spark - landing, historised vault, dimensional views, reports."""
