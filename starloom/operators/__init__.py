from .aggregate import (distinct_projection, first_by_key, group_count, group_max,
                        rows_at_group_max)
from .filters import require_columns, where_equal
from .joins import (bounded_broadcast, cast_key_join, conform, hot_key_join, hot_keys, role_lookup,
                    star_join)
from .order import clustered_for_write, preview, sorted_distinct, top_k
from .project import as_map, cast_columns, map_element, quoted, rename, select_star
from .quality import (dq_fk_orphans, dq_non_empty, dq_null_profile, dq_pk_unique,
                      dq_references, dq_schema, raise_on_failure)
