"""Sources and sinks: interaction tables and the parameter-keyed artefact store."""

from recsift.sources.commits import Commit, commit, commits, latest, load_or_commit, load_or_compute
from recsift.sources.id_map import decode_ids, encode_ids, id_map
from recsift.sources.interactions import (
    INTERACTION_COLUMNS,
    CsvScan,
    interaction_rows,
    interactions,
    interactions_table,
    one_row_per_pair,
    read_csv_table,
    scan_csv,
    source_kind,
    source_paths,
)
from recsift.sources.store import (
    artefact_path,
    commit_runs,
    data_fingerprint,
    fit_or_load_als,
    materialize,
    model_exists,
    path_exists,
    append_runs,
    read_runs,
    source_key,
    table_exists,
)

__all__ = ["INTERACTION_COLUMNS", "interaction_rows", "interactions", "interactions_table", "read_csv_table",
           "artefact_path", "fit_or_load_als", "load_or_compute", "materialize",
           "append_runs", "table_exists", "data_fingerprint", "source_key",
           "source_kind", "source_paths", "path_exists", "model_exists", "one_row_per_pair", "id_map", "encode_ids",
           "decode_ids", "CsvScan", "scan_csv", "commit_runs", "read_runs",
           "Commit", "commit", "commits", "latest", "load_or_commit"]
