"""Clean free-text organisation names and map each to a parent name, as Spark DataFrame jobs."""

from namekin.functions.similarity import Similarity
from namekin.operators.attach import attach_parents, distinct_rows
from namekin.operators.cleaning import clean_name, clean_names
from namekin.operators.parents import assign_parents
from namekin.operators.spelling import apply_spelling, build_spelling
from namekin.operators.vocabulary import build_vocabulary, name_frequency, profile_frequencies
from namekin.plans.matching import Settings, match_parents

__all__ = [
    "Settings", "Similarity", "apply_spelling", "assign_parents", "attach_parents", "build_spelling",
    "build_vocabulary", "clean_name", "clean_names", "distinct_rows", "match_parents",
    "name_frequency", "profile_frequencies",
]
