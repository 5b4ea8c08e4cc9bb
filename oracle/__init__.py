"""Independent SQL per query key, for an engine that reads the same tables.

Only the definition of the input rows (the driver tables seen as flights) and
the fixed value tables are shared with the library; every operator is stated
again here, in plain SQL and mostly join-first.
"""

from __future__ import annotations

from oracle import cleaning, models, quality, reports, trees

SQL: dict[str, str] = {**cleaning.SQL, **quality.SQL, **reports.SQL, **models.SQL, **trees.SQL}
