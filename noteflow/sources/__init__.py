"""Readers and writers."""

from .files import (csv_to_parquet, load_model, materialize, read_aligned, read_csv_ordered, read_csv_source,  # noqa: F401
                    read_embeddings, read_positions, read_splits, read_variants, read_vectors, save_model, scratch_path,
                    write_csv_sink, write_embeddings, write_metrics, write_splits)
