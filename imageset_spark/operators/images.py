"""Pixel operators: the fixed preprocessing contract as jobs over image tables.

An image row holds ``rows``, ``cols``, ``pixels`` (row-major integers),
``code_max`` (largest value of the file's integer type) and ``photometric``.
Jobs store one resized plane per image; the three equal channels are made when
the plane is read, which keeps stored data at a third.
"""

from dataclasses import dataclass, field
from math import isfinite

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.folders import open_path

# Fixed values of the preprocessing contract.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)
INVERTED = "MONOCHROME1"
CONFIG_KEYS = {
    ("version", None): "version",
    ("input", "format"): "input_format",
    ("input", "dimensions"): "dimensions",
    ("intensity", "invert_monochrome1"): "invert_monochrome1",
    ("intensity", "scaling"): "scaling",
    ("intensity", "output_min"): "output_min",
    ("intensity", "output_max"): "output_max",
    ("image", "width"): "width",
    ("image", "height"): "height",
    ("image", "channels"): "channels",
    ("image", "resize"): "resize",
    ("image", "preserve_aspect_ratio"): "preserve_aspect_ratio",
    ("tensor", "layout"): "layout",
    ("tensor", "dtype"): "dtype",
    ("normalization", "mean"): "mean",
    ("normalization", "std"): "std",
}

#: Pixels that are worked on at once, 8 bytes each and a few copies.
STACK_PIXELS = 1 << 21
PLANE_SCHEMA = "sample_id string, height int, width int, plane array<float>"


def _typed(key, attribute, value):
    """A configuration value of the type that the attribute has, or an error naming the key."""
    label, default = ".".join(filter(None, key)), ImageSpec.__dataclass_fields__[attribute].default
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if attribute == "version":
        return str(value)
    if isinstance(default, bool):
        holds, kind = isinstance(value, bool), "true or false"
    elif isinstance(default, int):
        holds, kind = isinstance(value, int) and not isinstance(value, bool), "a whole number"
    elif isinstance(default, float):
        holds, kind = number, "a number"
    elif isinstance(default, str):
        holds, kind = isinstance(value, str), "text"
    else:
        holds = isinstance(value, (list, tuple)) and all(
            isinstance(v, (int, float)) and not isinstance(v, bool) for v in value)
        kind = "a list of numbers"
    if not holds:
        raise ValueError(f"{label} must be {kind}, got {value!r}")
    return float(value) if isinstance(default, float) else value


@dataclass(frozen=True)
class ImageSpec:
    """Parameters of the preprocessing contract; unsupported values raise."""

    version: str = "1.0"
    input_format: str = "dicom"
    height: int = 224
    width: int = 224
    channels: int = 3
    dimensions: int = 2
    invert_monochrome1: bool = True
    scaling: str = "min_max"
    output_min: float = 0.0
    output_max: float = 1.0
    resize: str = "bilinear"
    preserve_aspect_ratio: bool = False
    layout: str = "CHW"
    dtype: str = "float32"
    mean: tuple = field(default=CHANNEL_MEAN)
    std: tuple = field(default=CHANNEL_STD)

    def __post_init__(self):
        supported = {
            "input_format": "dicom", "channels": 3, "dimensions": 2, "scaling": "min_max", "resize": "bilinear",
            "preserve_aspect_ratio": False, "layout": "CHW", "dtype": "float32",
        }
        for name, value in supported.items():
            if getattr(self, name) != value:
                raise ValueError(f"{name} must be {value!r}, got {getattr(self, name)!r}")
        bounds = (self.output_min, self.output_max)
        sizes = (len(self.mean), len(self.std))
        rules = {
            "version must not be blank": self.version.strip() != "",
            "height and width must be positive": min(self.height, self.width) > 0,
            "output bounds must be finite and ascending":
                all(map(isfinite, bounds)) and bounds[0] < bounds[1],
            "mean and std need one value per channel": sizes == (self.channels,) * 2,
            "mean must be finite": all(map(isfinite, self.mean)),
            "std must be finite and positive": all(isfinite(s) and s > 0 for s in self.std),
        }
        for rule, holds in rules.items():
            if not holds:
                raise ValueError(rule)

    @classmethod
    def from_config(cls, config):
        """Build from a nested mapping, such as a parsed YAML file."""
        flat = {}
        if not isinstance(config, dict):
            raise ValueError("preprocessing configuration must be a mapping")
        sections = {section for section, name in CONFIG_KEYS if name is not None}
        for section, value in config.items():
            if section in sections and not isinstance(value, dict):
                raise ValueError(f"{section} must be a mapping")
            entries = value.items() if isinstance(value, dict) else [(None, value)]
            flat.update({(section, name): entry for name, entry in entries})
        absent = [".".join(filter(None, key)) for key in CONFIG_KEYS if key not in flat]
        if absent:
            raise ValueError(f"preprocessing configuration lacks {', '.join(sorted(absent))}")
        values = {name: _typed(key, name, flat[key]) for key, name in CONFIG_KEYS.items()}
        return cls(**{n: tuple(v) if isinstance(v, list) else v for n, v in values.items()})

    def to_config(self):
        """The nested mapping that :meth:`from_config` reads."""
        config = {}
        for (section, name), attribute in CONFIG_KEYS.items():
            value = getattr(self, attribute)
            value = list(value) if isinstance(value, tuple) else value
            if name is None:
                config[section] = value
            else:
                config.setdefault(section, {})[name] = value
        return config


def invert_mono1(images, enabled=True):
    """Mirror the codes of images whose photometric type counts white as zero."""
    flipped = F.transform("pixels", lambda v: (F.col("code_max") - v).cast("bigint"))
    as_is = F.transform("pixels", lambda v: v.cast("bigint"))
    wanted = (F.col("photometric") == INVERTED) & F.lit(enabled)
    return images.withColumn("pixels", F.when(wanted, flipped).otherwise(as_is))


def scaled_plane(pixels):
    """Codes scaled to [0, 1] by their own range; a uniform image becomes all zeros.

    The range is bound to a lambda variable. As a plain column the optimizer may
    copy it into the inner lambda and take minimum and maximum once per pixel.
    """
    bounds = F.array(F.struct(F.array_min(pixels).alias("lo"), F.array_max(pixels).alias("hi")))

    def scale(bound):
        span = (bound["hi"] - bound["lo"]).cast("double")
        return F.transform(
            pixels,
            lambda v: F.when(span > 0, (v - bound["lo"]).cast("double") / span).otherwise(0.0),
        )

    return F.element_at(F.transform(bounds, scale), 1)


def min_max_scale(images, pixels="pixels", out="plane"):
    return images.withColumn(out, scaled_plane(F.col(pixels)))


def replicate_channels(plane, channels=3):
    """One grey plane as equal channels, channel first."""
    return F.flatten(F.array_repeat(plane, channels))


def normalize_channels(plane, mean=CHANNEL_MEAN, std=CHANNEL_STD):
    """Normalised channels of a grey plane, channel first, flat."""

    def channel(m, s):
        return F.transform(plane, lambda v: (v.cast("double") - F.lit(m)) / F.lit(s))

    return F.concat(*[channel(m, s) for m, s in zip(mean, std)])


def _axis_weights(size_in, size_out):
    """Left neighbour, right neighbour and right weight per output position."""
    place = np.maximum((np.arange(size_out) + 0.5) * (size_in / size_out) - 0.5, 0.0)
    left = np.minimum(place.astype("int64"), size_in - 1)
    return left, np.minimum(left + 1, size_in - 1), place - left


def resize_planes(stack, height, width):
    """Bilinear resize of images of one size, stacked: half-pixel centres, edges clamped, no smoothing.

    Rows across first, then down; only the rows that some output row reads are
    worked out. All images of the stack at once.
    """
    top, bottom, down = _axis_weights(stack.shape[1], height)
    left, right, across = _axis_weights(stack.shape[2], width)
    needed, place = np.unique(np.concatenate((top, bottom)), return_inverse=True)
    read = stack[:, needed]
    wide = read[:, :, left] * (1.0 - across) + read[:, :, right] * across
    down = down[:, None]
    return wide[:, place[:height]] * (1.0 - down) + wide[:, place[height:]] * down


def resize_plane(plane, height, width):
    """:func:`resize_planes` of one image."""
    return resize_planes(plane[None], height, width)[0]


def scale_planes(codes, code_max=None, inverted=None):
    """Codes of stacked images (one image per row) scaled by the range of each; uniform images become zeros.

    Images that ``inverted`` marks are mirrored first.
    """
    codes = codes.astype("float64")
    if inverted is not None and inverted.any():
        codes[inverted] = code_max[inverted, None] - codes[inverted]
    low, high = codes.min(1, keepdims=True), codes.max(1, keepdims=True)
    span = high - low
    return np.divide(codes - low, span, out=np.zeros_like(codes), where=span > 0)


def decoded_plane(codes, photometric, spec):
    """The resized plane of a decoded image; only inversion needs the type's largest code."""
    inverted = spec.invert_monochrome1 and photometric == INVERTED
    code_max = np.array([np.iinfo(codes.dtype).max], "float64") if inverted else None
    if codes.ndim != 2:
        raise ValueError(f"an image needs two dimensions, not {codes.ndim}")
    scaled = scale_planes(codes.reshape(1, -1), code_max, np.array([inverted]))
    return resize_planes(scaled.reshape(1, *codes.shape), spec.height, spec.width)[0].astype("float32").ravel()


def _integers(column):
    return column.to_numpy(zero_copy_only=False).astype("int64")


def stacked(batch, column):
    """The images of an Arrow batch by size: yields (places in the batch, array with one image per row, rows, cols).

    Images come straight out of the list column's buffer; no image is looked at alone.
    """
    rows, cols = _integers(batch.column("rows")), _integers(batch.column("cols"))
    values = batch.column(column)
    lengths = pc.fill_null(pc.list_value_length(values), -1).to_numpy(zero_copy_only=False)
    if (lengths != rows * cols).any():
        raise ValueError("an image's pixels do not fill its rows and columns")
    sizes, group = np.unique(np.stack((rows, cols), 1), axis=0, return_inverse=True)
    for k, (height, width) in enumerate(sizes.tolist()):
        at = np.flatnonzero(group.ravel() == k)
        own = values if len(sizes) == 1 else values.take(pa.array(at))
        yield at, own.flatten().to_numpy(zero_copy_only=False).reshape(len(at), height * width), height, width


def _list_column(planes, kind):
    """Stacked planes as an Arrow list column."""
    n, size = planes.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(size))
    return pa.ListArray.from_arrays(offsets, pa.array(planes.ravel(), kind))


def _bounded(batches, height, width):
    """Slices of the batches whose planes before and after resizing fit in memory together."""
    for batch in batches:
        if not len(batch):
            continue
        largest = max(height * width, int((_integers(batch.column("rows")) * _integers(batch.column("cols"))).max()))
        step = max(1, STACK_PIXELS // largest)
        for begin in range(0, len(batch), step):
            yield batch.slice(begin, step)


def _resized(batch, column, height, width, dtype, scale):
    out = np.empty((len(batch), height * width), dtype)
    for at, codes, rows, cols in stacked(batch, column):
        planes = scale(at, codes).reshape(len(at), rows, cols)
        out[at] = resize_planes(planes, height, width).reshape(len(at), -1)
    return out


def resize_bilinear(images, height, width, plane="plane"):
    """Resize the planes of a table (sample_id, rows, cols, plane), images of one size together."""

    def run(batches):
        for batch in _bounded(batches, height, width):
            planes = _resized(batch, plane, height, width, "float64", lambda at, codes: codes.astype("float64"))
            size = [pa.array(np.full(len(batch), v, np.int32)) for v in (height, width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sample_id"), *size, _list_column(planes, pa.float64())],
                ["sample_id", "height", "width", "plane"],
            )

    return images.select("sample_id", "rows", "cols", plane).mapInArrow(
        run, "sample_id string, height int, width int, plane array<double>"
    )


def table_planes(batch, spec):
    """Resized planes of an Arrow batch of a pixel table, one per row."""
    inverted = pc.fill_null(pc.equal(batch.column("photometric"), INVERTED), False).to_numpy(zero_copy_only=False)
    inverted = inverted & spec.invert_monochrome1
    code_max = batch.column("code_max").to_numpy(zero_copy_only=False).astype("float64")
    return _resized(
        batch, "pixels", spec.height, spec.width, "float32",
        lambda at, codes: scale_planes(codes, code_max[at], inverted[at]),
    )


def stored_planes(batch, spec, column="plane"):
    """Planes of an Arrow batch that holds them already resized, one per row."""
    values = batch.column(column)
    lengths = pc.fill_null(pc.list_value_length(values), -1).to_numpy(zero_copy_only=False)
    if (lengths != spec.height * spec.width).any():
        raise ValueError("a stored plane does not have the size of the specification")
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def preprocess_images(images, spec):
    """Invert, scale and resize whole images, those of one size together."""

    def run(batches):
        for batch in _bounded(batches, spec.height, spec.width):
            size = [pa.array(np.full(len(batch), v, np.int32)) for v in (spec.height, spec.width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sample_id"), *size, _list_column(table_planes(batch, spec), pa.float32())],
                ["sample_id", "height", "width", "plane"],
            )

    columns = ["sample_id", "rows", "cols", "code_max", "photometric", "pixels"]
    return images.select(*columns).mapInArrow(run, PLANE_SCHEMA)


def preprocess_files(files, decoder, spec):
    """Decode and preprocess image files without ever storing their full pixels.

    ``files`` has ``sample_id`` and ``content``; ``decoder`` turns bytes into
    ``(integer array, photometric)``.
    """
    height, width = spec.height, spec.width

    def run(table):
        for batch in table:
            planes = []
            for content in batch["content"]:
                planes.append(decoded_plane(*decoder(bytes(content)), spec))
            yield pd.DataFrame(
                {"sample_id": batch["sample_id"], "height": height, "width": width,
                 "plane": planes}
            )

    return files.select("sample_id", "content").mapInPandas(run, PLANE_SCHEMA)


def preprocess_paths(manifest, decoder, spec, opener=open_path, path_col="image_path", tasks=None,
                     errors="raise"):
    """Read, decode and preprocess the image of every manifest row inside the task.

    Only manifest rows are moved between executors; pixels are read where they
    are used and leave the task as one resized plane next to the manifest
    columns. ``opener(path, "rb")`` opens a file that every executor can reach.
    Rows are spread over ``tasks`` by path, by default one per shuffle
    partition: a manifest is far smaller than its images, so its own
    partitioning says nothing about the work. An image that cannot be read or
    decoded fails the job, or with ``errors="keep"`` gets a NULL plane and its
    fault in ``error``.
    """
    if errors not in ("raise", "keep"):
        raise ValueError(f"errors must be 'raise' or 'keep', got {errors!r}")
    tasks = tasks or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    height, width = spec.height, spec.width

    def plane(path):
        with opener(path, "rb") as handle:
            return decoded_plane(*decoder(handle.read()), spec)

    def attempt(path):
        try:
            return plane(path), None
        except Exception as error:
            return None, f"{type(error).__name__}: {error}"

    def run(table):
        for batch in table:
            out = batch.assign(height=height, width=width)
            if errors == "raise":
                yield out.assign(plane=[plane(path) for path in batch[path_col]])
            else:
                tried = [attempt(path) for path in batch[path_col]]
                yield out.assign(plane=[p for p, _ in tried], error=[e for _, e in tried])

    schema = T.StructType(
        [
            *manifest.schema.fields,
            T.StructField("height", T.IntegerType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("plane", T.ArrayType(T.FloatType())),
            *([T.StructField("error", T.StringType())] if errors == "keep" else []),
        ]
    )
    return manifest.repartition(tasks, path_col).mapInPandas(run, schema)


def to_tensor(planes, spec):
    """Model input of every stored plane: three normalised channels as floats."""
    tensor = normalize_channels(F.col("plane"), spec.mean, spec.std).cast("array<float>")
    return planes.withColumn("tensor", tensor).withColumn(
        "shape", F.array(F.lit(spec.channels), F.col("height"), F.col("width"))
    )


def with_planes(manifest, planes, missing="raise"):
    """Every manifest row with its stored plane.

    A row without one fails the job; with ``missing="keep"`` its plane is NULL.
    """
    if missing not in ("raise", "keep"):
        raise ValueError(f"missing must be 'raise' or 'keep', got {missing!r}")
    joined = manifest.join(planes, "sample_id", "left")
    if missing == "keep":
        return joined
    problem = F.concat(F.lit("no preprocessed image for "), "sample_id")
    return joined.withColumn("plane", F.coalesce("plane", F.raise_error(problem).cast("array<float>")))


def training_examples(manifest, planes, spec, missing="raise"):
    """Manifest rows with their model input and the label as a float; see :func:`with_planes`."""
    labelled = manifest.select("sample_id", F.col("label").cast("float").alias("label"))
    return to_tensor(with_planes(labelled, planes, missing), spec)
