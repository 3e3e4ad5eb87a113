"""Scalar functions on names, paths, scores and empty values."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EXTENSIONS = ("jpg", "jpeg", "png", "bmp")


def file_name(path: Column) -> Column:
    """The last part of a path with / or \\ separators."""
    return F.element_at(F.split(path, r"[\\/]"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def is_image(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)).isin(*EXTENSIONS)


def identity(path: Column) -> Column:
    """The stem without its last ``_`` part; the stem itself if there is none."""
    return F.regexp_replace(stem(path), "_[^_]*$", "")


def source_prefix(who: Column) -> Column:
    return F.regexp_replace(who, "_[^_]*$", "")


def _plain(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/", path).rstrip("/")


def relative(path: Column, root: str) -> Column:
    """The path below ``root``, null if it isn't there; scheme and host count for neither."""
    plain = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")
    return F.when(F.startswith(plain, F.lit(_plain(root) + "/")), F.substr(plain, F.lit(len(_plain(root)) + 2)))


def top_folder(path: Column, root: str) -> Column:
    """The first segment below ``root``."""
    return F.split(relative(path, root), "/")[0]


def path_parts(path: Column) -> Column:
    """Sorts as paths do, part by part."""
    return F.split(path, "/")


def priority(dataset: Column, order: list[str], prefix: str = "") -> Column:
    """Place in ``order`` after taking off ``prefix``; unknown names come last."""
    name = F.regexp_replace(dataset, f"^{prefix}", "") if prefix else dataset
    at = F.array_position(F.array(*map(F.lit, order)), name).cast("int") - 1
    return F.when(at < 0, len(order)).otherwise(at)


def two_lists(first: list[str], then: list[str]) -> list[str]:
    """An order of priority for ``priority``: one list after the other, each name at its first place."""
    return list(dict.fromkeys([*first, *then]))


def person_of_cluster(cluster: Column) -> Column:
    return F.concat(F.lit("cluster_"), cluster.cast("string"))


def cluster_of_person(person: Column) -> Column:
    """The inverse of ``person_of_cluster``; null if the text is none."""
    return F.replace(person, F.lit("cluster_"), F.lit("")).try_cast("long")


def cache_key(dataset: Column, name: Column) -> Column:
    """The file name under which merged sets keep an image."""
    return F.concat_ws("_", dataset, name)


def image_name(number: Column) -> Column:
    return F.format_string("img_%05d.jpg", number.cast("long"))


def sequence_name(number: Column) -> Column:
    return F.format_string("%05d.jpg", number.cast("long"))


def box_area(box: Column) -> Column:
    """Of (left, top, right, bottom); never below 0."""
    side = lambda a, b: F.greatest(F.lit(0.0), (box[b] - box[a]).cast("double"))
    return side(0, 2) * side(1, 3)


def largest_box(boxes: Column) -> Column:
    """Place, from 0, of the box with the largest area in an array of boxes; the first of equals, null if there is none."""
    areas = F.transform(boxes, box_area)
    return F.when(F.size(boxes) > 0, F.array_position(areas, F.array_max(areas)).cast("int") - 1)


def escaped_html(c: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def file_url(path: Column) -> Column:
    return F.concat(F.lit("/file?path="), F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")))


def mime_type(path: Column) -> Column:
    kind = F.lower(F.regexp_extract(file_name(path), r"\.([^.]*)$", 1))
    return F.when(kind.isin("jpg", "jpeg"), "image/jpeg").when(kind == "png", "image/png").when(kind == "bmp", "image/bmp").otherwise("application/octet-stream")


def dest_name(split: Column, dataset: Column, name: Column) -> Column:
    return F.concat_ws("/", split, F.concat_ws("_", dataset, name))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def shown_person(path: Column, person: Column) -> Column:
    return F.coalesce(empty_to_null(stem(path)), empty_to_null(person), F.lit("(unknown)"))


def percent(score: Column) -> Column:
    """Rounded half up, as browsers do."""
    return F.floor(score * 100 + F.lit(0.5)).cast("int")


def band(score: Column) -> Column:
    return F.when(percent(score) >= 50, "green").otherwise("red")


def fixed(c: Column, digits: int, missing: str = "n/a") -> Column:
    """As printf writes a double: the digits next to its binary value, where ``format_string`` rounds its shortest decimal form half up."""
    text = F.call_function("format_number", c, F.lit(("0." + "0" * digits).rstrip(".")))
    half = 0.5 / 10**digits  # the only value that it rounds wrong: no digit stands before its 5
    text = F.when(F.abs(c) == half, F.concat(F.when(c < 0, "-").otherwise(""), F.lit(f"{half:.{digits}f}"))).otherwise(text)
    return F.when(c.isNotNull(), text).otherwise(missing)


def stored_path(path: Column, data_dir: str) -> Column:
    return F.concat(F.lit(data_dir.rstrip("/") + "/"), file_name(path))
