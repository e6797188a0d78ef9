"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from podium.llm import leaks, names, nearest, runs, sentences, similar, splitting, tokenizing, turns

QUERIES = {"p1_found": runs.p1_found, "p1_runs": runs.p1_runs, "p3_found": nearest.p3_found, "p4_found": names.p4_found, "p5_found": similar.p5_found, "p6_found": turns.p6_found, "p6_turns": turns.p6_turns, "p6_texts": turns.p6_texts, "p7_found": splitting.p7_found, "p7_pieces": splitting.p7_pieces, "p8_ids": tokenizing.p8_ids, "p9_found": leaks.p9_found, "p9_leaks": leaks.p9_leaks, "p10_found": sentences.p10_found}

SQL = {"p1_found": runs.P1_SQL, "p1_runs": runs.P1_RUNS_SQL, "p3_found": nearest.P3_SQL, "p6_found": turns.P6_SQL, "p6_turns": turns.P6_TURNS_SQL, "p7_found": splitting.P7_SQL, "p7_pieces": splitting.P7_PIECES_SQL, "p9_found": leaks.P9_SQL}
