"""A Spark engine that builds source-code corpora: select repositories, clean and judge files, deduplicate, split, write."""
