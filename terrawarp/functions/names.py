"""File names: parsing, split tokens, tile and output names. Columns only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Roles a name may end with, and tokens that mean validation.
ROLES, VAL_TOKENS = ("image", "annotation"), ("val", "test")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, "(?<=.)\\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.regexp_extract(name, "(?<=.)(\\.[^.]*)$", 1)


def parse_name(name: Column) -> Column:
    """struct(tile_id, token, role), or null for names that follow neither form: id1_id2_role, id1_id2_token_role.
    More parts than four are accepted, without a token."""
    parts = F.split(stem(name), "_", -1)
    role = F.element_at(parts, -1)
    token = F.when(F.size(parts) == 4, F.get(parts, 2))
    found = F.struct(F.concat_ws("_", F.get(parts, 0), F.get(parts, 1)).alias("tile_id"), token.alias("token"), role.alias("role"))
    return F.when((F.size(parts) >= 3) & role.isin(*ROLES), found)


def split_of(token: Column, val_tokens=VAL_TOKENS) -> Column:
    return F.when(token.isNull(), F.lit(None).cast("string")).when(F.lower(token).isin(*val_tokens), "val").otherwise("train")


def tile_name(prefix: Column, x0: Column, y0: Column, x1: Column, y1: Column, fmt: str = "tif") -> Column:
    return F.concat(F.concat_ws("_", prefix.cast("string"), *[c.cast("string") for c in (x0, y0, x1, y1)]), F.lit(f".{fmt}"))


def prefix_of(name: Column) -> Column:
    """Prefix of inference tiles: the tile id if the name parses, else its stem."""
    return F.coalesce(parse_name(name)["tile_id"], stem(name))


def output_name(name: Column) -> Column:
    return F.concat(stem(name), F.lit("_segmentation.tif"))
