"""pointlake — word counts, product popularity and k-center with outliers as
PySpark DataFrame operators.

    from pointlake import read_lines, word_count, read_points, mr_kcenter_outliers
    counts = word_count(read_lines(spark, "docs/"))
    result = mr_kcenter_outliers(read_points(spark, "points.txt"), k=10, z=100, parts=16)
"""

from types import ModuleType as _ModuleType

from .functions.distance import euclidean, min_distance, nearest
from .functions.text import java_space_split, split_lines, utf16_length
from .operators.baskets import (
    pair_count,
    popularity_crosscheck,
    product_customer_pairs,
    product_customer_pairs_salted,
    product_popularity,
    product_popularity_bitmaps,
    product_popularity_distinct,
    purchases,
    top_products,
)
from .operators.center_index import nearest_of_many
from .operators.coreset_tree import tree_coreset
from .operators.fft import fft_centers, fft_coreset
from .operators.geometry import (
    cluster_sizes,
    kcenter_objective,
    kcenter_outliers,
    nearest_center,
    objective_by_selection,
    outliers_by_selection,
    point_center_distance,
)
from .operators.heavy import top_products_by_summaries
from .operators.kcenter import (
    ball_removal,
    ball_weights,
    coreset_order,
    greedy_cover,
    heaviest_ball,
    initial_guess,
    mr_kcenter_outliers,
    seq_weighted_outliers,
    solve_weighted_outliers,
)
from .operators.selection import kth_largest, largest_rows
from .operators.wordcount import (
    approx_distinct_words,
    avg_word_length,
    distinct_word_count,
    doc_term_freq,
    word_count,
    word_count_partitioned,
    word_count_salted,
    word_sketches,
    words,
)
from .sources.points import points_from_array, points_from_columns, read_points
from .sources.sink import publish, read_published
from .sources.text import lines_of_documents, read_lines
from .sources.transactions import parse_transactions, read_transactions, transactions_from_tables

__all__ = [name for name, value in dict(globals()).items()
           if not name.startswith("_") and not isinstance(value, _ModuleType)]
