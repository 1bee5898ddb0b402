"""Sleep, diabetes and hypertension warehouse as PySpark batch jobs.

Layers: ``bronze`` (typed raw extracts), ``silver`` (cleansed rows with a
reproducible patient key) and ``gold`` (dimensions, a wide observation fact and
six marts).  Everything is a lazy DataFrame transformation; only the jobs in
``somnolake.plans.jobs`` write.
"""
