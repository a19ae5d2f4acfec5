"""noteflow: note-classification dataset preparation and evaluation as Spark DataFrame operators.

Sub-packages
------------
functions  Column-level scalar functions (text normalisation, sentence split, hash draws).
operators  DataFrame -> DataFrame operators (cleaning, joins, ordered dedup, splits,
           negative sampling, label encoding, features, models, evaluation).
sources    Readers and writers (CSV, Parquet splits, embeddings, models, metrics).
plans      Composed pipelines, the fixture views and the query registry.
streaming  Micro-batch adapter that runs the batch operators on a stream.
"""

__version__ = "0.1.0"
