"""tallyforge — investor and portfolio-risk analytics as lazy Spark jobs.

Layers:
  sources/    bronze schemas, driver-table adapter, document stage, seeded generators, sinks
  functions/  Column-expression builders (text, masking, keys)
  operators/  reusable DataFrame -> DataFrame operators (CDC, text signals, search,
              data tests, governance, lineage, reports)
  plans/      silver and gold models, semantic views, gated build
  streaming/  Structured Streaming jobs (change-feed apply, document sync)
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
