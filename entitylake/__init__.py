"""Entity collections on Spark: query, page, extract, catalogue and report.

Every operator takes and returns DataFrames; see the sub-packages:

``functions``  Column helpers (sort keys, JSON, labels, scalar functions)
``operators``  query options, paging, catalogue, counts, upserts, profiles
``sources``    page lake, record, CSV, snapshot and document readers / writers
``streaming``  page-arrival streams
``plans``      the composites: extraction, reports, attribute dictionary
"""

from entitylake.lake import Lake
from entitylake.session import local_session, scratch_dir

__all__ = ["Lake", "local_session", "scratch_dir"]
