"""Feature tables from the XML dumps of question-and-answer sites, as Spark DataFrame transforms."""
