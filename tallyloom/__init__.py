"""Corpus preparation and n-gram modelling as Spark DataFrame operators."""

from .operators.cleaning import clean_methods, flatten_one_level, isolate_bad_rows, step_report
from .operators.dedupe import dedupe_keep_last, duplicate_report
from .operators.evaluation import (
    accuracy_by_complexity,
    best_configs,
    fit_for,
    large_scale_eval,
    perplexity,
    score_grid,
    topk_accuracy,
)
from .operators.generation import backoff_candidates, complete, make_prompts, prediction_rows
from .operators.mining import (
    attach_license,
    build_record,
    chunk_number,
    mining_cap,
    mining_report,
    scan_changes,
    search_repos,
)
from .operators.ngrams import FittedNGramModel, NGramModel, extract_ngrams, ngram_counts
from .operators.sampling import proportional_sample, sample_from_large_repos, stratified_split
from .operators.trees import (
    all_metrics,
    branch_complexity,
    extract_declarations,
    leading_comment,
    leaf_tokens,
    tree_metrics,
)
from .sources.records import metric_columns, read_dataset, read_records_jsonl
from .sources.sinks import write_chunked_jsonl, write_dataset, write_predictions, write_results

__all__ = [name for name in dir() if not name.startswith("_")]
