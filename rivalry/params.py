"""Run parameters.

Every value the reference hard-codes is exposed here as a default and can be
overridden per call.  Nothing in the library reads a clock or a global session.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for matching results)
# ---------------------------------------------------------------------------
# Click-log channels (`bs`) kept by the co-view jobs.
CHANNELS = ("1", "13", "8", "311210")
# Trailing windows, in days.
GMV_DAYS = 365          # SKU GMV before the latest switching snapshot
SESSION_DAYS = 91       # click log for co-view switching
SOLD_DAYS = 183         # "sold" SKUs for the overlap denominator
VOLUME_DAYS = 31        # SKU sales for the volume rank
# Rank band for volume neighbours.
RANK_BAND = 10
# Top-N per origin brand in the similarity merge.
SWITCH_TOP_N = 20
OVERLAP_TOP_N = 30
# Similarity type tags written to the merged list.
TYPE_SWITCH = "1"
TYPE_OVERLAP = "2"
TYPE_VOLUME = "3"
TYPE_DECLARED = "4"
# Domain tag of the brand profile.
BRAND_DOMAIN = "brand"
# ---------------------------------------------------------------------------
