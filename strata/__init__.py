"""strata — a layered lakehouse and customer-scoring library on Spark.

Layers: raw files -> Bronze tables (sources, streaming) -> Silver entities
(operators.clean) -> Gold master table (operators.features / operators.master)
-> profiling, preparation, model training, evaluation and scoring
(operators.profile / prep / train / evaluate / score).

Every public function is ``DataFrame -> DataFrame`` (or takes a session and
paths); nothing here holds a module-level session.
"""

__all__ = ["session"]
