"""Token vocabularies: building, growing, comparing and saving."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import PAD, START, STOP

RING_DIGITS = "123456"


class Vocabulary:
    """Token ids: the special tokens first, then the others in the order given."""

    def __init__(self, tokens: Iterable[str] = (), pad: str = PAD, bos: str = START, eos: str = STOP, unk: str | None = None):
        self.pad, self.bos, self.eos, self.unk = pad, bos, eos, unk
        self.ids: dict[str, int] = {}
        self.update([pad, bos, eos, *([unk] if unk else []), *tokens])

    @classmethod
    def build(cls, tokens: Iterable[str], **special) -> Vocabulary:
        """From distinct tokens of data: sorted, then ring digits that are missing."""
        found = sorted(set(tokens) - {special.get("pad", PAD), special.get("bos", START), special.get("eos", STOP)})
        return cls([*found, *(d for d in RING_DIGITS if d not in found)], **special)

    @classmethod
    def from_frame(cls, df: DataFrame, column: str = "tokens", **special) -> Vocabulary:
        rows = df.select(F.explode(column).alias("t")).distinct().collect()  # a row for each distinct token
        return cls.build((r.t for r in rows), **special)

    def update(self, tokens: Iterable[str]) -> None:
        for t in tokens:
            self.ids.setdefault(t, len(self.ids))

    def add(self, token: str) -> int:
        self.update([token])
        return self.ids[token]

    def delete(self, token: str) -> None:
        """Later ids move up."""
        del self.ids[token]
        self.ids = {t: i for i, t in enumerate(self.ids)}

    def get(self, token: str) -> int | None:
        return self.ids.get(token, self.ids.get(self.unk) if self.unk else None)

    def __contains__(self, token: str) -> bool:
        return token in self.ids

    def __len__(self) -> int:
        return len(self.ids)

    def __eq__(self, other) -> bool:
        return isinstance(other, Vocabulary) and self.ids == other.ids

    __hash__ = None

    def tokens(self) -> list[str]:
        return list(self.ids)

    def as_map(self):
        return F.create_map(*[F.lit(x) for kv in self.ids.items() for x in kv])

    def as_inverse_map(self):
        return F.create_map(*[F.lit(x) for t, i in self.ids.items() for x in (i, t)])

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps({"tokens": self.tokens(), "pad": self.pad, "bos": self.bos, "eos": self.eos, "unk": self.unk}, indent=1, ensure_ascii=False), encoding="utf-8")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        return cls(spec["tokens"], **{k: spec.get(k) for k in ("pad", "bos", "eos", "unk") if spec.get(k) is not None})


def ids_frame(df: DataFrame, column: str = "tokens") -> DataFrame:
    """token, id of all distinct tokens in code-point order, counted from 0."""
    from pyspark.sql.window import Window

    distinct = df.select(F.explode(column).alias("token")).distinct()
    return distinct.select("token", (F.row_number().over(Window.orderBy("token")) - 1).alias("id"))  # a row for each distinct token


def difference(base: DataFrame, curated: DataFrame) -> DataFrame:
    """token, side: 'unused' if only base has it, 'new' if only curated does."""
    unused = base.join(curated, "token", "left_anti").select("token", F.lit("unused").alias("side"))
    return unused.union(curated.join(base, "token", "left_anti").select("token", F.lit("new").alias("side")))
