"""caseflow — case-report analytics on Spark.

Ingest delimited case-report batches, keep the latest version of each case,
assemble one row per case, derive label vocabularies and reproducible splits,
featurize, score with a small network, calibrate per-label thresholds, report
multi-label metrics, validate against a knowledge base, and run evolutionary
search whose fitness pass is a distributed Spark job.

Sub-packages:
  functions/  column expressions (no actions, no UDFs)
  sources/    readers, sinks, artefacts, case-shaped views over driver tables
  operators/  DataFrame operators grouped by pipeline stage
  plans/      end-to-end compositions and the query catalogue
  streaming/  file-stream ingest and streaming scoring
"""

__all__ = ["session"]
