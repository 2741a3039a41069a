"""Row-at-a-time rendering of the rejection rules, to hold the Spark jobs against."""

from collections import Counter
from math import isfinite, isnan

from imageset_spark.schemas import CLASS_LABELS as LABELS


def _gone(value):
    return value is None or isnan(value)


def map_reasons(labels, classes):
    """{patient: reason or None} from label tuples (id, x, y, w, h, target) and (id, class)."""
    by_class, by_label = {}, {}
    for pid, name in classes:
        if pid is not None and name is not None:
            by_class.setdefault(pid, set()).add(name)
    for pid, *rest in labels:
        if pid is not None:
            by_label.setdefault(pid, []).append(rest)
    out = {pid: "conflicting_classes" for pid, names in by_class.items() if len(names) > 1}
    for pid, group in by_label.items():
        if pid not in out:
            out[pid] = _map_reason(group, by_class.get(pid, set()))
    return out


def _map_reason(group, names):
    targets = {row[4] for row in group if not _gone(row[4])}
    cells = [[_gone(value) for value in row[:4]] for row in group]
    if not names:
        return "missing_class"
    if not targets:
        return "missing_target"
    if len(targets) > 1:
        return "conflicting_targets"
    (target,), (name,) = targets, names
    if target not in (0.0, 1.0):
        return "invalid_target"
    if LABELS.get(name) != target:
        return "class_target_mismatch"
    if target == 0:
        full = any(not gone for row in cells for gone in row)
        return "unexpected_box_for_negative" if full else None
    if any(all(row) for row in cells):
        return "missing_box_for_positive"
    if any(any(row) for row in cells):
        return "incomplete_box"
    if any(row[2] <= 0 or row[3] <= 0 for row in group):
        return "invalid_box_dimensions"
    if any(row[0] < 0 or row[1] < 0 for row in group):
        return "invalid_box_coordinates"
    return None


def validate(images, boxes, audit):
    """images [(id, label)], boxes in source order [(id, x, y, w, h)], audit {id: (ok, ndim, w, h)}.

    Returns valid ids, valid boxes, ledger [(id, reason)] and the number of removed copies.
    """
    copies = Counter(pid for pid, _ in images)
    ledger, candidates = [], {}
    for pid, label in dict(images).items():
        if copies[pid] > 1:
            ledger.append((pid, "duplicate_image_record"))
        elif pid not in audit:
            ledger.append((pid, "image_file_not_found"))
        elif not audit[pid][0]:
            ledger.append((pid, "unreadable_dicom"))
        elif audit[pid][1] != 2 or audit[pid][2] * audit[pid][3] == 0:
            ledger.append((pid, "invalid_image_dimensions"))
        else:
            candidates[pid] = label
    unique = list(dict.fromkeys(boxes))
    for box in unique:
        if box[0] not in copies:
            ledger.append((box[0], "unknown_image_reference"))
    valid = set()
    for pid, label in candidates.items():
        own = [box for box in unique if box[0] == pid]
        reason = "unexpected_box_for_negative" if label == 0 and own else None
        for box in own if reason is None else []:
            reason = _fault(box[1:], audit[pid][2], audit[pid][3])
            if reason:
                break
        if reason:
            ledger.append((pid, reason))
        else:
            valid.add(pid)
    return valid, [b for b in unique if b[0] in valid], ledger, len(boxes) - len(unique)


def _fault(box, width, height):
    x, y, w, h = box
    if not all(map(isfinite, box)):
        return "non_finite_box"
    if x < 0 or y < 0:
        return "invalid_box_coordinates"
    if w <= 0 or h <= 0:
        return "invalid_box_dimensions"
    return "box_outside_image" if x + w > width or y + h > height else None
