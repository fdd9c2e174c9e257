"""shelfwise: layered retail-feed cleaning and assortment-gap analytics on Spark.

``functions``  column expressions (cleaning, exact money arithmetic)
``operators``  DataFrame in, DataFrame out (rules, dedupe, ranking, gap, forecast)
``sources``    landing, bronze, silver, quarantine and report files
``plans``      the three dataset loads and the gold report
``streaming``  the same loads and the message feed as Structured Streaming jobs
"""
