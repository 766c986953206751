import numpy as np
import pyarrow as pa

from pixelchange.llm.common import text_hashes


def test_text_hashes_tell_strings_apart():
    words = ["", "\0", "\0\0", "a", "a\0", "\0a", "ab", "ba", "é", "日本語"] + ["x" * n for n in range(2, 80)] + ["x" * n + "y" for n in range(80)]
    words += [f"w{i}" for i in range(50_000)]
    own = text_hashes(pa.array(words))
    assert len(np.unique(own)) == len(words)
    assert (text_hashes(pa.array(words[::-1]))[::-1] == own).all()
    assert (text_hashes(pa.array(words).slice(7, 20)) == own[7:27]).all()
    bits = np.unpackbits(own.view(np.uint8)).reshape(-1, 64).mean(axis=0)
    assert 0.48 < bits.min() and bits.max() < 0.52
    assert len(text_hashes(pa.array([], pa.string()))) == 0
