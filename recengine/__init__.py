"""recengine: catalogue analytics and collaborative-filtering recommendations on Spark.

Every operator takes and returns DataFrames; nothing creates a session, and what comes to the driver is bounded (counts, plans, small reports).
"""

from recengine.functions.columns import lifecycle_status, parse_cjk_date, text_contains
from recengine.operators.als import (als_fit, als_grid_search, als_recommend, als_rmse,
                                     split_by_hash, split_sizes)
from recengine.operators.analysis import hot_by_group, hot_by_month
from recengine.operators.bitmaps import bitmap_counts, distinct_counts, id_bitmaps, merged_bitmaps
from recengine.operators.clean import assign_row_ids, clean_catalog, dedup_keep_first, dense_ids
from recengine.operators.evaluate import (item_cf_predictions, item_cf_rmse, rmse, rmse_of,
                                          user_cf_predictions, user_cf_rmse)
from recengine.operators.inner_products import top_products
from recengine.operators.monthly import add_batch, monthly_rankings
from recengine.operators.ratings import composite_rating
from recengine.operators.recommend import item_cf_recommend, user_cf_recommend
from recengine.operators.similarity import cosine_neighbors, neighbor_lists
from recengine.operators.skew import profile_keys, salted_join
from recengine.operators.summary import (cardinality_summary, group_count, rating_profile,
                                         stacked_value_counts)
from recengine.operators.topk import ranked_entities, top_k_per_group, zip_frames, zip_ranked
from recengine.sources.buckets import item_cf_from_tables, save_bucketed
from recengine.sources.io import read_table, write_table
from recengine.sources.partitions import key_ranges, range_predicates, sample_keys
from recengine.sources.staged import staged_overwrite

__all__ = [
    "add_batch", "als_fit", "als_grid_search", "als_recommend", "als_rmse", "assign_row_ids",
    "bitmap_counts", "cardinality_summary", "clean_catalog", "composite_rating", "cosine_neighbors",
    "dedup_keep_first", "dense_ids", "distinct_counts", "group_count", "hot_by_group",
    "hot_by_month", "id_bitmaps", "item_cf_from_tables", "item_cf_predictions", "item_cf_recommend",
    "item_cf_rmse", "key_ranges", "lifecycle_status", "merged_bitmaps", "monthly_rankings",
    "neighbor_lists", "parse_cjk_date", "profile_keys", "range_predicates", "ranked_entities",
    "rating_profile", "read_table", "rmse", "rmse_of", "salted_join", "sample_keys",
    "save_bucketed", "split_by_hash", "split_sizes", "stacked_value_counts", "staged_overwrite",
    "text_contains", "top_k_per_group", "top_products", "user_cf_predictions", "user_cf_recommend",
    "user_cf_rmse", "write_table", "zip_frames", "zip_ranked",
]
