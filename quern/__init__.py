"""quern: document retrieval and question-answering analytics as Spark plans."""
