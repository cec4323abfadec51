"""Web question-answer mining, scoring and corpus preparation as Spark jobs."""
