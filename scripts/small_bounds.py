"""Every registered query with sessions and orders cut at (2, 3) against its oracle.

Usage: python scripts/small_bounds.py [sf_dir] [name ...]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickweave.sources import derived  # noqa: E402

derived.DEFAULT_MAX_EVENTS_PER_RECORD, derived.DEFAULT_MAX_ITEMS_PER_RECORD = 2, 3
for f in (derived.session_records, derived.build_session_records):
    f.__defaults__ = (2, 3)

import scripts.oracle_check as check  # noqa: E402

if __name__ == "__main__":
    check.main()
