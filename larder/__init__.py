"""larder: inventory data-quality and star-schema building on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames built from built-in
Spark expressions, so a whole pipeline stays one lazy plan that Catalyst can
prune, push down and re-plan adaptively. See README.md for the operator map.
"""

__version__ = "0.1.0"
