"""The jobs as queries, with their SQL."""

from __future__ import annotations

from jobs import candidate_release, sequence_library

QUERIES = {
    "job1_sequence_library": sequence_library.job1_sequence_library,
    "job2_candidate_release": candidate_release.job2_candidate_release,
}

ORACLE_SQL = {"job1_sequence_library": sequence_library.JOB1_SQL, "job2_candidate_release": candidate_release.JOB2_SQL}
