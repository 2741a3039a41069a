from .annotations import read_classes, read_labels, read_manifest, unparsed_cells
from .files import (
    audit_images,
    audit_paths,
    checksum_files,
    checksum_lines,
    checksum_paths,
    listed_paths,
    read_files,
    verify_checksums,
)
from .folders import list_images, open_path, read_images
from .sinks import (
    append_batch,
    append_history,
    canonical,
    read_batches,
    report_json,
    write_canonical,
    write_files,
    write_planes,
    write_report,
    write_splits,
)
from .versions import prepare, publish, read_published, verify_published

__all__ = [
    "append_batch", "append_history", "audit_images", "audit_paths", "canonical", "checksum_files", "checksum_lines", "checksum_paths",
    "list_images", "listed_paths", "open_path", "read_classes", "read_files", "read_images", "read_labels",
    "prepare", "publish", "read_batches", "read_manifest", "read_published", "report_json", "unparsed_cells", "verify_checksums", "verify_published",
    "write_canonical", "write_files", "write_planes",
    "write_report", "write_splits",
]
