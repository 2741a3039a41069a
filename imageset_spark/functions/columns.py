"""Column expressions; all of them stay inside whole-stage codegen."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CLASS_LABELS, NEGATIVE_DECISION, POSITIVE_DECISION


def _col(value):
    return value if isinstance(value, Column) else F.col(value)


def nan_to_null(value):
    """Missing numbers are NULL everywhere in this package, never NaN."""
    return F.nullif(_col(value), F.lit(float("nan")))


def is_number(value):
    """True for every number, also infinite ones; false for NaN, NULL for NULL.

    NaN sorts above infinity, so one plain comparison does it. As a filter it
    reaches the scan.
    """
    return _col(value) <= F.lit(float("inf"))


def is_present(value):
    """True for every number, also infinite ones; false for NULL and NaN."""
    return F.coalesce(is_number(value), F.lit(False))


def any_present(names):
    return reduce(or_, [is_present(name) for name in names])


def all_present(names):
    return reduce(and_, [is_present(name) for name in names])


def any_missing(names):
    return ~all_present(names)


def is_finite(value):
    """False for NULL, NaN and both infinities."""
    value = _col(value)
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))


def is_blank(value):
    """True for text that is empty once all surrounding whitespace is gone."""
    return F.regexp_replace(_col(value), r"^\s+|\s+$", "") == ""


def class_label(value, labels=CLASS_LABELS):
    """Binary label of a source class; NULL for a class outside ``labels``."""
    value = _col(value)
    expr = F.lit(None).cast("int")
    for name, label in labels.items():
        expr = F.when(value == name, F.lit(label)).otherwise(expr)
    return expr


def number_of(value, names):
    """Place of a text in ``names``, NULL if it is none of them."""
    expr = F.lit(None).cast("int")
    for number, name in enumerate(names):
        expr = F.when(_col(value) == name, F.lit(number)).otherwise(expr)
    return expr


def name_of(number, names):
    """Inverse of :func:`number_of`; a NULL number gives NULL."""
    expr = F.lit(None).cast("string")
    for i, name in enumerate(names):
        expr = F.when(_col(number) == i, F.lit(name)).otherwise(expr)
    return expr


def replace_text(value, old, new):
    """Replace every literal occurrence of ``old``."""
    return F.replace(_col(value), F.lit(old), F.lit(new))


def remap_prefix(value, old, new):
    """Replace ``old`` only where the text starts with it, and only once."""
    value = _col(value)
    rest = F.substr(value, F.lit(len(old) + 1))
    return F.when(value.startswith(old), F.concat(F.lit(new), rest)).otherwise(value)


def stem(path, suffix):
    """File name without its folder and ``suffix``; empty if the suffix differs."""
    escaped = suffix.replace(".", r"\.")
    return F.regexp_extract(_col(path), rf"([^/]+){escaped}$", 1)


def sigmoid(logit):
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(logit)))


def decision(score, threshold, positive=POSITIVE_DECISION, negative=NEGATIVE_DECISION):
    """Inclusive decision rule: a score at the threshold is positive."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(_col(score) >= limit, F.lit(positive)).otherwise(F.lit(negative))
