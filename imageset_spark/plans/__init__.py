from .evaluate import evaluate_predictions, score_files, score_planes
from .ingest import ingest, ingest_files, ingestion_report
from .split import split_manifest

__all__ = ["evaluate_predictions", "ingest", "ingest_files", "ingestion_report",
           "score_files", "score_planes", "split_manifest"]
