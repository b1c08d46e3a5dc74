"""Scalar functions over metadata: keys, paths, kinds, sizes and ratios. Null in gives null out unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Object suffix by dataset, file kinds by extension, where a video's address has its id and what that is
#: made of, sizes of the image gate.
SUFFIX = {"documents": "json", "papers": "pdf"}
KINDS = {
    "video": ("mp4", "mkv", "webm", "flv"),
    "audio": ("m4a", "mp3", "ogg", "wav"),
    "subtitle": ("srt", "vtt", "ass"),
    "image": ("jpg", "jpeg", "png", "webp"),
    "metadata": ("json",),
    "description": ("description",),
}
VIDEO_PLACES = ("youtube.com/watch?v=", "youtube.com/embed/", "youtube.com/v/", "youtube.com/shorts/", "youtu.be/")
VIDEO_ID = "[a-zA-Z0-9_-]{11}"
SECTION_SECONDS = 600
LEAST_SIDE, MOST_SIDE = 256, 7680


def or_default(value: Column, default: Column) -> Column:
    """The value unless it is null or empty."""
    return F.coalesce(F.when(value != "", value), default)


def as_fraction(similarity: Column) -> Column:
    """Similarity as a fraction: values above 1 are percentages; NaN and null become null."""
    s = F.when(F.isnan(similarity), None).otherwise(similarity)
    return F.when(s > 1, F.round(s / 100, 12)).otherwise(s)


def storage_key(hash_: Column, url: Column, prefix: str, dataset: str = "images") -> Column:
    """prefix/hash.suffix; the address is hashed where there is no hash."""
    return F.concat(F.lit(prefix + "/"), or_default(hash_, F.sha2(url, 256)), F.lit("." + SUFFIX.get(dataset, "jpg")))


def shard_key(key: Column, prefix: str) -> Column:
    """prefix/first five characters/key.jpg."""
    return F.concat(F.lit(prefix + "/"), F.substring(key, 1, 5), F.lit("/"), key, F.lit(".jpg"))


def object_key(address: Column, scheme: str = "s3") -> Column:
    """The key of scheme://bucket/key."""
    return F.regexp_replace(address, rf"^{scheme}://[^/]+/", "")


def object_address(key: Column, bucket: str, scheme: str = "s3") -> Column:
    return F.concat(F.lit(f"{scheme}://{bucket}/"), key)


def aspect_ratio(width: Column, height: Column) -> Column:
    return F.when(height != 0, width / height).otherwise(F.lit(0.0))


def percent(a: Column, b: Column) -> Column:
    """a / b as a percentage with up to two decimals, 0 % where b is 0."""
    value = F.round(F.when(b != 0, a / b).otherwise(F.lit(0.0)) * 100, 2)
    return F.concat(value.cast("string"), F.lit("%"))


def paper_path(paper_id: Column, versions: Column, root: str) -> Column:
    """Place of a paper's last version. New-style ids sit under their month, old-style ids under their archive."""
    parts = F.split(paper_id, "/")
    last = F.try_element_at(versions, F.lit(-1))
    new = F.concat(F.lit(root + "/pdf/"), F.substring_index(paper_id, ".", 1), F.lit("/"), paper_id, last, F.lit(".pdf"))
    old = F.concat(F.lit(root + "/"), F.get(parts, F.lit(0)), F.lit("/pdf/"), F.substring(F.get(parts, F.lit(1)), 1, 4), F.lit("/"), F.get(parts, F.lit(1)), last, F.lit(".pdf"))
    return F.when(F.size(parts) == 1, new).when(F.size(parts) == 2, old)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^./]*)$", 1))


def file_kind(name: Column) -> Column:
    out = F
    for kind, names in KINDS.items():
        out = out.when(extension(name).isin(*names), kind)
    return out.otherwise("other")


def content_kind(content: Column) -> Column:
    """PDF by its first bytes, TEXT where the bytes are valid UTF-8, else null."""
    return F.when(F.substring(content, 1, 4) == F.lit(b"%PDF"), "PDF").when(F.is_valid_utf8(content.cast("string")), "TEXT")


def video_id(url: Column) -> Column:
    """The 11 characters behind a place of video ids anywhere in a text, that of the first place in the list if there are
    several; null where there are none."""
    behind = F.concat(*[_behind(F.split(url, rf"\Q{place}\E")) for place in VIDEO_PLACES])
    return F.substring(F.get(F.filter(behind, lambda x: x.rlike("^" + VIDEO_ID)), F.lit(0)), 1, 11)


def _behind(parts: Column) -> Column:
    """What stands behind each separator."""
    return F.slice(parts, F.lit(2), F.size(parts))


def is_video_url(url: Column) -> Column:
    """Whether a text begins with the address of a video, with or without its protocol and www."""
    bare = F.regexp_replace(F.regexp_replace(url, "^https?://", ""), r"^www\.", "")
    return reduce(lambda a, b: a | b, [F.startswith(bare, F.lit(p)) & F.substring(bare, F.lit(len(p) + 1), F.lit(11)).rlike(f"^{VIDEO_ID}$") for p in VIDEO_PLACES])


def sections(duration: Column, seconds: int = SECTION_SECONDS) -> Column:
    """(index from 1, start, end) of each stretch of a video; the last ends with the video; one section if it is short."""
    starts = F.when(duration > seconds, F.sequence(F.lit(0), (duration - 1).cast("int"), F.lit(seconds))).when(duration >= 0, F.array(F.lit(0)))
    return F.transform(starts, lambda s: F.struct((s / seconds + 1).cast("int").alias("index"), s.alias("start"), F.least(s + seconds, duration.cast("int")).alias("end")))


def split_millis(ms: Column) -> Column:
    return F.struct(F.floor(ms / 60_000).alias("minutes"), (F.floor(ms / 1000) % 60).alias("seconds"), (ms % 1000).alias("millis"))


def point_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def right_angle(angle: Column) -> Column:
    """The nearest multiple of 90 degrees within 0..270; halves go down."""
    return F.pmod(F.ceil((F.pmod(angle, F.lit(360)) - 45) / 90) * 90, F.lit(360)).cast("int")


def fit_size(width: Column, height: Column, box_w: int, box_h: int) -> Column:
    """(width, height) that fits into a box with the proportions kept; never less than 1."""
    scale = F.least(F.lit(float(box_w)) / width, F.lit(float(box_h)) / height)
    side = lambda x: F.greatest(F.round(x * scale), F.lit(1)).cast("int")
    return F.when((width > 0) & (height > 0), F.struct(side(width).alias("width"), side(height).alias("height")))


def image_gate(width: Column, height: Column, kind: Column) -> Column:
    """What is to be done with an image: ``reject`` (a side under 256), ``shrink`` (a side over 7680), ``convert``
    (no JPEG), or ``keep``; null sizes are rejected."""
    small = F.coalesce(F.least(width, height) < LEAST_SIDE, F.lit(True)) | width.isNull() | height.isNull()
    return F.when(small, "reject").when(F.greatest(width, height) > MOST_SIDE, "shrink").when(~F.upper(F.coalesce(kind, F.lit(""))).isin("JPG", "JPEG"), "convert").otherwise("keep")


def expand_source(source: Column) -> Column:
    """A source with the source it derives from before it, where it does."""
    return F.when(source.isin("cc12m_cleaned", "cc12m_woman"), F.array(F.lit("cc12m"), source)).otherwise(F.array(source))


def identity(*columns: Column) -> Column:
    """The first of the columns that isn't null or empty; an error where all are."""
    parts = [F.when(c.cast("string") != "", c.cast("string")) for c in columns]
    return F.coalesce(*parts, F.raise_error(F.lit("a record without identity")).cast("string"))


def retry_wait(attempt: Column, first: float = 1.0) -> Column:
    """Seconds before the n-th retry: doubled each time."""
    return F.lit(first) * F.pow(F.lit(2.0), attempt - 1)


def sorted_json(*columns: str) -> Column:
    """Compact JSON of the columns, keys sorted, nulls kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
