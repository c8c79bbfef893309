"""Array work inside a task takes little memory, whatever the size of a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tabwork.llm import quality
from tabwork.llm.common import chunks, text_buffers


def test_scoring_a_batch_takes_a_small_multiple_of_a_chunk():
    """In chunks of 2 MB, workers and JVM of one executor took more than 3000 MB in the corpus pipeline."""
    texts = [" ".join(f"w{(i * 31 + j) % 997}" for j in range(400)) for i in range(4000)]
    model = quality.QualityModel(np.linspace(-0.1, 0.1, quality.WIDTH), 0.1, 0.5)
    data, offsets = text_buffers(pa.array(texts))
    whole = model.score(data, offsets)
    tracemalloc.start()
    found = np.concatenate([model.score(data, offsets[lo : hi + 1]) for lo, hi in chunks(offsets)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(found, whole, rtol=1e-9) and peak < 40e6
