"""quern: synthetic question-answer data from text tables, as Spark DataFrame plans."""
