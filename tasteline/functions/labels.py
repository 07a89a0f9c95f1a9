"""Text forms: run-log fields, series labels, ordered tag labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Run-log formats, field names in line order, tags of the map.
ALS_LINE = (
    "With Rank:%s, Reg:%s, Alpha:%s, Maxiter:%s, Metric: %s, "
    "time TTL: %s, fit: %s, rec: %s, evl: %s"
)
ALS_FIELDS = ["Rank", "Reg", "Alpha", "Maxiter", "Metric", "Time_TTL", "Time_fit", "Time_rec", "Time_evl"]
ALS_PREFIX = "With"
BIAS_LINE = (
    "items:%s, users:%s, damping:%s, Metric: %s, "
    "time TTL: %s, fit: %s, rec: %s, evl: %s"
)
BIAS_FIELDS = ["items", "users", "damping", "Metric", "Time_TTL", "Time_fit", "Time_rec", "Time_evl"]
BIAS_FLAGS = ["items", "users"]
BIAS_PREFIX = "items"
LOG_NAME = "stats_"
MAP_TAGS = [
    "classical",
    "folk",
    "soul and reggae",
    "hip hop",
    "jazz and blues",
    "electronic",
    "hard rock",
    "metal",
]


def line_values(line: Column, fields: list[str], flags: list[str]) -> Column:
    """Values of the ``key:value`` parts of a log line, in order, as a struct.

    A part that reads ``null``, as a missing value is written, is null. A line
    whose parts are too few or of the wrong type fails the job.
    """
    kinds = ", ".join(f"{name} {'boolean' if name in flags else 'double'}" for name in fields)
    values = F.regexp_replace(F.translate(line, " ", ""), "[^,:]*:", "")
    values = F.regexp_replace(values, "(?<![^,])null(?![^,])", "")
    return F.from_csv(values, kinds, {"mode": "FAILFAST"})


def log_name(path: Column) -> Column:
    """Log name in a path: the last file ``stats_0_25.txt`` or folder of such a name."""
    rest = F.regexp_extract(F.substring_index(path, LOG_NAME, -1), "^[0-9A-Za-z_]*", 0)
    return F.when((rest == "") | ~path.contains(LOG_NAME), "").otherwise(F.concat(F.lit(LOG_NAME), rest))


def series_label(name: Column) -> Column:
    """``stats_0_25`` to ``spark 0.25``, ``stats_lenskit_1_0`` to ``lenskit 1.0``."""
    out = name
    for prefix, engine in (("stats_", "spark"), ("stats_lenskit_", "lenskit")):
        for whole in "01":
            start = f"{prefix}{whole}_"
            rest = F.substring(name, len(start) + 1, F.length(name))
            out = F.when(name.startswith(start), F.concat(F.lit(f"{engine} {whole}."), rest)).otherwise(out)
    return out


def ordered_tag(tag: Column, tags: list[str]) -> Column:
    """Tag with its place in ``tags`` in front: ``0_classical``; null if absent."""
    pairs = [F.lit(x) for i, t in enumerate(tags) for x in (t, f"{i}_{t}")]
    return F.try_element_at(F.create_map(*pairs), tag)
