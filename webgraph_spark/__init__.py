"""Web-crawl analytics on Spark: pages, links, robots files and duplicates as DataFrames."""
