"""Record curation and diverse-subset selection as Spark DataFrame jobs."""
