"""From raw interactions to stored train, val and test sets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tastemill.functions.hashing import DOWNSAMPLE_TAG, hash_below, validate_fraction
from tastemill.functions.ids import int_id
from tastemill.operators.bitmaps import distinct_counts, id_bitmaps, united
from tastemill.operators.cleaning import check_threshold, remove_zeros
from tastemill.operators.sampling import DEFAULT_WEIGHTS, downsample, tag_splits
from tastemill.operators.skew import apply_verdicts, key_verdicts
from tastemill.operators.splitting import apply_user_verdicts, drop_unobserved_items, user_verdicts
from tastemill.schema import ITEM, SPLIT, TRAIN, TRIPLE, USER
from tastemill.sources.storage import ArtifactStore
from tastemill.staging import Stage, scratch, stage_table

#: The published sample sizes (fixed values).
SAVED_FRACTIONS = (0.01, 0.05, 0.25, 1.0)
#: Number of the smallest sample that holds a row.
LEVEL = "level"


@dataclass(frozen=True)
class PrepConfig:
    fraction: float = 0.01
    seed: int = 42
    rm_unobserved: bool = True
    rm_zeros: bool = True
    low_threshold: int = 10
    weights: tuple[float, float, float] = DEFAULT_WEIGHTS
    share: float = 0.5
    #: Further columns that go with each row, such as the review flag; a later join is then not needed.
    carry: tuple[str, ...] = ()

    def __post_init__(self):
        validate_fraction(self.fraction)
        check_threshold(self.low_threshold)


def sampled_rows(interactions: DataFrame, config: PrepConfig) -> DataFrame:
    """Rated triples of the sampled users, with what is carried. Both filters are row-local.

    Sampling comes before the low-user filter, which works on whole users and so
    gives the same rows in either order, but now only sees the sample.
    """
    rows = interactions.select(*TRIPLE, *config.carry).filter(F.col(USER).isNotNull() & F.col(ITEM).isNotNull())
    rows = remove_zeros(rows) if config.rm_zeros else rows
    return downsample(rows, config.fraction, config.seed)


def prep_splits(interactions: DataFrame, config: PrepConfig, stage: Stage = stage_table) -> DataFrame:
    """Clean, sample and split; every row that is left carries its ``split``.

    The low-user filter and the put-back rule need the same per-user counts, so
    one aggregation and one join serve both. The input is read once, for the tagged
    rows; these are read three times: for the user list, for the item list, and for
    the result. The counts per user and per item are staged, as hot and exceptional
    keys and the total are all taken from them.
    """
    tagged = tag_splits(sampled_rows(interactions, config), config.seed, config.weights, config.share)
    if config.rm_unobserved or config.low_threshold:
        tagged = stage("tagged", tagged)
        listed = user_verdicts(tagged, config.low_threshold, config.rm_unobserved, stage=stage)
        tagged = apply_user_verdicts(tagged, stage("users", listed))
    return drop_unobserved_items(tagged, stage) if config.rm_unobserved else tagged


def _schema(interactions: DataFrame, config: PrepConfig):
    return interactions.select(*TRIPLE, *config.carry).withColumn(SPLIT, F.lit(TRAIN)).schema


def load_splits(interactions: DataFrame, config: PrepConfig, store: ArtifactStore) -> DataFrame:
    """The stored splits of this configuration, built first if need be.

    If a ladder of samples with these settings is stored, they are read from it.
    """
    steps = _steps(SAVED_FRACTIONS)
    if config.fraction in steps and store.has("ladder", **_ladder_key(config, steps)):
        return of_sample(load_ladder(interactions, config, store, steps), steps.index(config.fraction))

    def stage(name: str, df: DataFrame) -> DataFrame:
        # Lists of keys are kept with the splits; rows and counts on the way to them are not.
        return store.frame(f"{name}-verdicts", lambda: df, **asdict(config)) if name in ("users", "items") else stage_table(name, df)

    with scratch(interactions.sparkSession):
        return store.splits(lambda: prep_splits(interactions, config, stage), _schema(interactions, config), **asdict(config))


def _steps(fractions: Sequence[float]) -> tuple[float, ...]:
    return tuple(sorted(set(map(float, fractions))))


def _ladder_key(config: PrepConfig, steps: tuple[float, ...]) -> dict:
    return asdict(replace(config, fraction=steps[-1])) | {"steps": steps}


def ladder(interactions: DataFrame, config: PrepConfig, steps: Sequence[float], stage: Stage = stage_table) -> DataFrame:
    """The splits of all samples of ``steps`` (growing fractions) as one table with a ``level``.

    A sample's users are those below a cut of one draw, so samples are nested and a user's level is the
    first step that takes them. User rules look at whole users and hold in every sample alike. A held-out
    row also needs its item in train, which it is from the first step on that has a train row of it. So
    the splits of step i are the rows up to level i. The input is read once, for the tagged rows of the
    largest sample.
    """
    rows = sampled_rows(interactions, replace(config, fraction=steps[-1]))
    # What the first step does not take has the level of the second, and so on.
    first = F.lit(len(steps) - 1)
    for i in reversed(range(len(steps) - 1)):
        first = F.when(hash_below(validate_fraction(steps[i]), config.seed, DOWNSAMPLE_TAG, USER), i).otherwise(first)
    tagged = stage("tagged", tag_splits(rows, config.seed, config.weights, config.share).withColumn(LEVEL, first))
    if config.rm_unobserved or config.low_threshold:
        listed = user_verdicts(tagged, config.low_threshold, config.rm_unobserved, stage=stage)
        tagged = apply_user_verdicts(tagged, stage("users", listed))
    if not config.rm_unobserved:
        return tagged
    train = F.col(SPLIT) == TRAIN
    items = tagged.groupBy(ITEM).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.min(F.when(train, F.col(LEVEL))), F.lit(len(steps))).alias("seen_from")
    )
    late = stage("items", key_verdicts(stage("item-profile", items), ITEM, F.col("seen_from") > 0, keep=("seen_from",)))
    joined = apply_verdicts(tagged, late, ITEM, "left")
    level = F.when(train, F.col(LEVEL)).otherwise(F.greatest(F.col(LEVEL), F.coalesce("seen_from", F.lit(0))))
    return joined.withColumn(LEVEL, level).drop("seen_from").filter(F.col(LEVEL) < len(steps))


def of_sample(ladder_rows: DataFrame, step: int) -> DataFrame:
    """The splits of one step: a choice of partitions."""
    return ladder_rows.filter(F.col(LEVEL) <= step).drop(LEVEL)


def load_ladder(interactions: DataFrame, config: PrepConfig, store: ArtifactStore, steps: tuple[float, ...]) -> DataFrame:
    """The stored ladder, partitioned by level and split, built first if need be."""
    key = _ladder_key(config, steps)

    def stage(name: str, df: DataFrame) -> DataFrame:
        return store.frame(f"ladder-{name}", lambda: df, **key)

    schema = _schema(interactions, config).add(LEVEL, IntegerType())
    return store.frame("ladder", lambda: ladder(interactions, config, steps, stage), (USER, ITEM), (LEVEL, SPLIT), schema, **key)


def ladder_counts(ladder_rows: DataFrame, steps: Sequence[float]) -> DataFrame:
    """``fraction, split, n_rows, n_users, n_items`` of every step, from bitmaps of the levels.

    Rows are looked at once; a step's sets are unions of its levels' bitmaps. Ids must fit INT.
    """
    ids = ladder_rows.select(LEVEL, SPLIT, int_id(USER), int_id(ITEM))
    bitmaps = id_bitmaps(ids, LEVEL, SPLIT)
    fractions = F.array(*[F.lit(float(f)) for f in steps])
    upward = bitmaps.withColumn("step", F.explode(F.sequence(F.col(LEVEL), F.lit(len(steps) - 1))))
    counts = distinct_counts(united(upward, "step", SPLIT), "step", SPLIT)
    return counts.select(F.get(fractions, F.col("step")).alias("fraction"), SPLIT, "n_rows", "n_users", "n_items")


def save_splits(
    interactions: DataFrame,
    store: ArtifactStore,
    fractions: tuple[float, ...] = SAVED_FRACTIONS,
    low_threshold: int = 10,
    seed: int = 42,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Store the splits of several fractions in one table; returns their sizes per fraction and split.

    ``load_splits`` finds the published fractions there.
    """
    steps = _steps(fractions)
    stored = load_ladder(interactions, PrepConfig(steps[-1], seed, low_threshold=low_threshold, carry=carry), store, steps)
    return ladder_counts(stored, steps)
