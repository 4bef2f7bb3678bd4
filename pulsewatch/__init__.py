"""Daily KPI anomaly alerts as Spark jobs.

``sources``    reading the warehouse tables, staging, sinks and run history
``functions``  column expressions: cleaning, number texts, links
``operators``  reusable DataFrame steps: screening, calendar fill, detector ...
``plans``      the products built from them: account, tag and territory alerts,
               the labelling export, reports and the outbox
"""
