"""Usage analytics for an enterprise assistant, its notebooks and its custom agents.

Everything is a plain function from DataFrame to DataFrame:

* ``sources``    landed files, log scans, tables and snapshots
* ``functions``  column expressions (JSON scalars, resource paths, shares)
* ``operators``  reshaping, normalisation, directory upserts, quality checks
* ``plans``      views, recipes, the question catalogue and the two jobs
* ``streaming``  routing, incremental adoption, de-duplication, name harvesting
"""
