"""Word lists for sentiment scoring.

The parquet ``documents`` hold invented words, so real sentiment words never
occur in them. The lists below are frequent tokens of those texts; the oracle
SQL uses the same literals. Real deployments load their lists with
``sources.files.read_word_list`` and pass them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Stop, positive and negative word lists used by the queries.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "de", "la", "der",
    "que", "le", "die", "und", "des", "les", "et", "el",
)
POSITIVE_WORDS = ("that", "it", "on", "was", "be", "with", "by", "at", "er", "ou", "tion", "un")
NEGATIVE_WORDS = ("for", "as", "re", "an", "this", "are", "from", "es", "th", "en", "ment", "ing")

# Largest word list turned into an in-plan literal set; bigger lists are joined.
MAX_LITERAL_WORDS = 100_000


def words_of(df: DataFrame, col: str = "word", limit: int = MAX_LITERAL_WORDS) -> list[str]:
    """Bring a word list to the driver after checking its size against ``limit``.

    A lexicon is a small dimension; the check makes sure an unexpectedly large
    input fails loudly instead of being shipped into every task.
    """
    n = df.count()
    if n > limit:
        raise ValueError(f"word list has {n} entries, more than {limit}; join it instead")
    return [r[0] for r in df.select(col).distinct().collect()]
