"""Catalogue rankings: most popular entities per category and per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.operators.topk import ranked_entities, zip_ranked


def hot_by_group(course: DataFrame, group: str = "type",
                 entities: Sequence[str] = ("name", "school", "instructor"),
                 measure: str = "participants_number", *, k: int = 10, how: str = "inner",
                 by_id: bool = True, id_col: str = "id", suffix: str = "_num",
                 with_rank: bool = True, sort: bool = False) -> DataFrame:
    """Top-``k`` entities of each kind per group, side by side on rank.

    Each ranking sums ``measure`` (as bigint) by (id, group, entity) when ``by_id`` (so each
    catalogue row is ranked on its own and an entity may repeat) or by (group, entity).
    ``how="inner"`` keeps ranks present in every ranking; ``"left"`` keeps all ranks of the
    first one. Output: group, e1, e1<suffix>, e2, ..., rn; ``sort`` orders it by group and first measure
    (descending), then rank.
    """
    ranked = ranked_entities(course, [group], list(entities), measure, k=k,
                             id_col=id_col if by_id else None)
    out = zip_ranked(ranked, [group], list(entities), value_names=[e + suffix for e in entities], how=how)
    if sort:
        out = out.orderBy(F.col(group).asc_nulls_first(), F.col(entities[0] + suffix).desc_nulls_last(), "rn")
    return out if with_rank else out.drop("rn")


def hot_by_month(course: DataFrame, date: str = "start_time_date",
                 entities: Sequence[str] = ("name", "instructor", "school"),
                 measure: str = "participants_number", *, k: int = 10, how: str = "inner",
                 suffix: str = "_pns", with_rank: bool = True) -> DataFrame:
    """Top-``k`` entities of each kind per (year, month) of ``date``, side by side on rank.

    Sums ``measure`` by (year, month, entity); rows with a null date form the null month,
    which ``how="left"`` keeps (unmatched) and ``"inner"`` drops.
    Output: year, ymonth, e1, e1<suffix>, ..., [rn].
    """
    ym = course.select(F.year(date).alias("year"), F.month(date).alias("ymonth"), *entities, measure)
    ranked = ranked_entities(ym, ["year", "ymonth"], list(entities), measure, k=k)
    return zip_ranked(ranked, ["year", "ymonth"], list(entities),
                      value_names=[e + suffix for e in entities], how=how, with_rank=with_rank)
