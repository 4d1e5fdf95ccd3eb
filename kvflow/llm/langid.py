"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams.  A document gets the language whose profile is
nearest by out-of-place distance: the sum, over the document's own most frequent n-grams, of how far each stands from
its place in the profile (profile_size where it isn't in it).

Defined results: null, empty and letterless texts give ``und`` with score 0; ties between languages go to the first
by name; ties between n-grams go to the shorter one, then the first by code point.
An empty table, or one without labelled rows, gives ``und`` for every row.  Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"
#: n-grams in a profile, of a language or a document.
PROFILE_SIZE = 300
#: More labels than this are refused: profiles (MAX_LANGUAGES x PROFILE_SIZE numbers) go to every task.
MAX_LANGUAGES = 2000
#: n-grams of a language that are sorted and counted at once, and distinct n-grams held before they are sent on.
BLOCK, HELD = 1 << 18, 1 << 20
#: Rows of a batch that goes back to the JVM.
ROWS = 1000
#: Code points below this can be letters; three of them and the order fit in 56 bits.
CODE_BITS = 18
CODES = 0x32400


def _letters() -> np.ndarray:
    """The code point itself for each letter, 0 for anything else."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(CODES)], np.int64)


class Alphabet:
    """n-grams of a text as numbers.  Words are runs of letters, lower-cased, with one blank on each side."""

    table: np.ndarray | None = None

    def grams(self, text: str | None) -> np.ndarray:
        """Letters, and pairs and triples of letters and blanks inside one padded word, in text order by kind."""
        if not text:
            return np.zeros(0, np.int64)
        if Alphabet.table is None:
            Alphabet.table = _letters()
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.zeros(len(code) + 2, np.int64)
        c[1:-1] = Alphabet.table[np.minimum(code, CODES - 1)]
        c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]
        pairs = (c[:-1] << CODE_BITS) | c[1:]
        inside = c[1:-1] != 0
        triples = (pairs[:-1] << CODE_BITS) | c[2:]
        return np.concatenate([c[c != 0], (pairs | (1 << 3 * CODE_BITS))[pairs != 0], (triples | (2 << 3 * CODE_BITS))[inside]])


def _ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, the smaller number first among equals."""
    found, n = np.unique(grams, return_counts=True)
    return found[np.argsort(-n, kind="stable")[:size]]


class Profiles:
    """Language names in order, and each language's n-grams in order."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE_SIZE) -> None:
        self.names, self.size = sorted(ranked), size
        self.known = np.unique(np.array([g for n in self.names for g in ranked[n]], np.int64))
        self.place = np.full((len(self.names), len(self.known) + 1), -1, np.int64)
        for i, n in enumerate(self.names):
            self.place[i, np.searchsorted(self.known, np.array(ranked[n], np.int64))] = np.arange(len(ranked[n]))

    def nearest(self, grams: np.ndarray) -> tuple[str, float]:
        """(language, score): score is 1 for a document whose n-grams all stand in their place, 0 if none is in the profile."""
        if not len(grams) or not self.names:
            return UNDETERMINED, 0.0
        own = _ranked(grams, self.size)
        at = np.searchsorted(self.known, own)
        at[(at == len(self.known)) | (self.known[np.minimum(at, len(self.known) - 1)] != own)] = len(self.known)
        place = self.place[:, at]
        distance = np.where(place < 0, self.size, np.abs(place - np.arange(len(own)))).sum(axis=1)
        best = int(distance.argmin())
        return self.names[best], max(0.0, 1.0 - float(distance[best]) / (self.size * len(own)))


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from all rows of df whose lang isn't null: partial n-gram counts per task, summed by (language, n-gram).

    Only the first PROFILE_SIZE n-grams of each language reach the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet = Alphabet()
        open_: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def close(name: str) -> None:
            found, n = np.unique(np.concatenate(open_.pop(name)), return_counts=True)
            held[name] = 0
            if name in total:
                found, at = np.unique(np.concatenate([total[name][0], found]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([total[name][1], n])).astype(np.int64)
            total[name] = found, n

        def ready() -> Iterator[pa.RecordBatch]:
            for name, (found, n) in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(n), pa.string()), pa.array(found), pa.array(n.astype(np.int64))], ["language", "gram", "n"])
            total.clear()

        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                grams = alphabet.grams(t.as_py())
                open_.setdefault(name, []).append(grams)
                held[name] = held.get(name, 0) + len(grams)
                if held[name] > BLOCK:
                    close(name)
            for name in list(open_):
                close(name)
            if sum(len(x[0]) for x in total.values()) > HELD:
                yield from ready()
        yield from ready()

    labelled = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("language")).where(
        "text is not null and language is not null"
    )
    counts = labelled.mapInArrow(partial, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("language").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE_SIZE)
    limit = MAX_LANGUAGES * PROFILE_SIZE
    rows = top.select("language", "gram", "place").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {MAX_LANGUAGES} languages are labelled")
    ranked: dict[str, dict[int, int]] = {}
    for r in rows:
        ranked.setdefault(r.language, {})[r.place] = r.gram
    return Profiles({name: [g[i] for i in sorted(g)] for name, g in ranked.items()})


def predict(df: DataFrame, profiles: Profiles, keep: list[str], text: str = "text") -> DataFrame:
    """The columns keep of df, with lang_pred and score.  keep has no column of these names."""
    shared = df.sparkSession.sparkContext.broadcast(profiles)
    kept = df.select(*keep)
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    # The text goes to Python once, also where it is kept.
    at = keep.index(text) if text in keep and isinstance(df.schema[text].dataType, T.StringType) else None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles_here, alphabet = shared.value, Alphabet()
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            got = [profiles_here.nearest(alphabet.grams(t.as_py())) for t in batch.column(len(keep) if at is None else at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*keep, "lang_pred", "score"],
            )

    picked = kept if at is not None else df.select(*keep, F.col(text).cast("string").alias("text_to_score"))
    return picked.mapInArrow(score, schema)


def fold(doc_id: Column, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo folds; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0).cast("long"))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the folds 0 and 2 of docs, then label every row: doc_id, held_out, lang_pred, score."""
    held_out = fold(F.col("doc_id")) == 1
    profiles = fit(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles, ["doc_id", "held_out"])
