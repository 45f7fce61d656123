"""Tag functions: list, entropy, joined form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.regex import extract_all


def tags_to_list(tags: Column) -> Column:
    """``<a><b>`` or ``|a|b|`` to an array; NULL and '' to an empty array."""
    tags = F.coalesce(tags, F.lit(""))
    return F.when(tags.startswith("<") & tags.endswith(">"), extract_all(tags, "<([^>]+)>")).otherwise(
        extract_all(tags, "([^|]+)"))


def join_tags(tag_list: Column) -> Column:
    return F.array_join(tag_list, "|")


def tag_entropy(tag_list: Column) -> Column:
    """Shannon entropy (bits) of the tag multiset; 0.0 if empty."""
    def add(total: Column, tag: Column) -> Column:
        share = F.size(F.filter(tag_list, lambda t: t == tag)) / F.size(tag_list)
        return total + share * F.log2(share)

    bits = F.lit(0.0) - F.aggregate(F.array_distinct(tag_list), F.lit(0.0), add)
    return F.when(F.size(tag_list) > 1, bits).otherwise(F.lit(0.0))
