"""Shop-URL normalisation used to match declared rivals to shops.

Rule: the URL must contain exactly one ``:``.  The part before it is cut to
its first four characters (``https`` → ``http``), one trailing ``/`` is
removed from the part after it, and the two are joined with ``:`` again.
Anything else (no colon, several colons, empty tail, NULL) gives NULL, which
an inner join then drops.  Built from column functions only, so it stays in
generated code and needs no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_url(col) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    parts = F.split(col, ":", -1)
    head = F.element_at(parts, 1)
    tail = F.element_at(parts, 2)
    well_formed = (F.size(parts) == 2) & (F.length(tail) > 0)
    fixed = F.concat(F.substring(head, 1, 4), F.lit(":"), F.regexp_replace(tail, "/$", ""))
    return F.when(well_formed, fixed)
