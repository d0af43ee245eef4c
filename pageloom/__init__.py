"""pageloom: Spark jobs over captured web pages, their links and their images."""
