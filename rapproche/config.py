"""Settings of a linkage run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Thresholds:
    """Cut-offs of the candidate search (model) and of the pair checks.

    ``model`` and ``city`` must be exceeded; the others must be reached.
    """

    model: float = 0.9
    city: float = 0.9
    address: float = 0.7
    postal_code: float = 1.0
    name: float = 0.8
    street_number: float = 1.0

    @classmethod
    def open(cls) -> "Thresholds":
        """Every candidate passes: the set to look at raw scores with."""
        return cls(-1.0, -1.0, -1.0, -1.0, -1.0, -1.0)


@dataclass(frozen=True)
class Parity:
    """One switch per known quirk of the linkage rules.

    False keeps the literal rule, True applies the documented intent.
    """

    compare_street_numbers: bool = False
    """Compare the two street numbers, instead of always scoring 1."""
    fix_trailing_postal_code: bool = False
    """Turn a trailing postal code the right way round and cut it out of the address."""
    fuzzy_postal_code: bool = False
    """Score postal codes by edit ratio instead of equality."""
    street_type_at_word_start: bool = False
    """Expand a street-type abbreviation only where it is a whole word."""
    remove_acronyms: bool = False
    """Cut bracketed acronyms out of free-text addresses."""
    skip_blank_ids: bool = False
    """Do not join rows whose raw id is empty."""
    keep_postal_text: bool = False
    """Keep the postal code as written, with its leading zeros."""
    remove_all_digits_from_city: bool = False
    """Replace each digit run of the city by itself, leaving no remainders."""

    @classmethod
    def intended(cls) -> "Parity":
        return cls(True, True, True, True, True, True, True, True)


@dataclass(frozen=True)
class SubwordConfig:
    """Size and training effort of the subword vocabulary."""

    vocab_size: int = 10_000
    character_coverage: float = 0.9995
    max_piece_length: int = 16
    seed_size: int = 1_000_000
    shrink: float = 0.75
    em_steps: int = 2


@dataclass(frozen=True)
class EmbeddingConfig:
    """Skip-gram settings; token vectors also average over character n-grams."""

    vector_size: int = 100
    window: int = 5
    min_count: int = 5
    epochs: int = 6
    min_n: int = 3
    max_n: int = 6
    negative: int = 15
    rate: float = 0.2
    buckets: int = 2_000_000
    """Rows that character n-grams are hashed to; only those in use are held."""
    shards: int = 64
    """Parts of the corpus that are trained side by side at most; their changes are averaged after each epoch."""
    shard_tokens: int = 100_000
    """Tokens below which a corpus is not cut in more shards."""
    seed: int = 17


@dataclass(frozen=True)
class NeighbourConfig:
    """Candidate search: number of trees, references per leaf, rows per work unit."""

    trees: int = 16
    leaf_size: int = 1024
    chunk_rows: int = 4096
    upper_levels: int = 16
    """Levels whose split points are broadcast; deeper ones are joined."""
    pivot_bytes: int = 64 * 1024 * 1024
    """Size of the centres that steer the exact search."""
    seed: int = 29
    exact: bool = False


@dataclass(frozen=True)
class LinkConfig:
    skip_similarity: bool = False
    thresholds: Thresholds = field(default_factory=Thresholds)
    parity: Parity = field(default_factory=Parity)
    subwords: SubwordConfig = field(default_factory=SubwordConfig)
    embedding: EmbeddingConfig = field(default_factory=EmbeddingConfig)
    neighbours: NeighbourConfig = field(default_factory=NeighbourConfig)
    query_table: str = "table2"
    model_dir: str | None = None
    """Folder of saved models: one fitted with these settings on such a corpus is used, else fitted and added."""
