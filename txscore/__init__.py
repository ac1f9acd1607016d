"""txscore: imbalanced transaction scoring on Spark DataFrames.

Sub-packages:
  sources    -- table readers/writers and the derived transaction view
  functions  -- Column-expression libraries (hashing, distributions, metric algebra)
  operators  -- fit/transform operators built from DataFrame ops
  plans      -- the named query catalogue (Spark plan + equivalent SQL)
  streaming  -- Structured Streaming preparation and scoring
"""

__version__ = "0.1.0"
