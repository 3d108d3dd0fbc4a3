"""Used-vehicle listings and commodity quotes, analysed with Spark DataFrames.

``functions``  column expressions (text, dates, numbers, HTML)
``sources``    readers, writers and the crawled-page scan
``operators``  DataFrame -> DataFrame building blocks
``plans``      the end-to-end analyses
``streaming``  incremental page ingest
"""
