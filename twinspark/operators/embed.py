"""The place of the embedding model: one model a worker, loaded when its first row comes; failures are rows, not exceptions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class NoFace(Exception):
    """What a model raises if there is nothing to embed."""


def embedder(load: Callable[[], Callable[[bytes], object]], dim: int, key: str = "key long") -> Callable[[DataFrame], DataFrame]:
    """Turns rows (key, content) into (key, v, reason): a vector of ``dim`` numbers of unit length, or why there is none.

    ``load`` runs in the worker and gives a function from bytes to numbers.
    """
    name = key.split(" ")[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for b in batches:
            out = []
            for k, content in zip(b[name], b["content"], strict=True):
                model = model or load()
                try:
                    v = np.asarray(model(bytes(content)), np.float32).reshape(-1)
                    n = float(np.linalg.norm(v))
                    if len(v) != dim:
                        raise ValueError(f"{len(v)} numbers, not {dim}")
                    if n <= 1e-9:
                        raise ValueError("a vector of almost no length")
                    out.append((k, (v / n).tolist(), None))
                except NoFace:
                    out.append((k, None, "no_face_detected"))
                except Exception as e:  # noqa: BLE001
                    out.append((k, None, f"error: {e}"))
            yield pd.DataFrame(out, columns=[name, "v", "reason"])

    return lambda rows: rows.select(name, "content").mapInPandas(run, f"{key}, v array<float>, reason string")
