"""What a Python worker keeps once a stage is over."""

import subprocess
import sys
from pathlib import Path

from kindred.llm import tokens

ROOT = Path(__file__).resolve().parents[2]
KEPT = """
import numpy as np
from kindred.llm import common
rss = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20
before, small = rss(), []
np.ones(2 << 20), np.ones(2 << 20)
for _ in range(3):
    held = []
    for _ in range(10):
        held.append(np.ones(3 << 18))
        small.append(bytearray(100_000))
    del held
print(rss() - before)
"""


def test_large_arrays_go_back_to_the_system():
    found = subprocess.run([sys.executable, "-c", KEPT], cwd=ROOT, capture_output=True, text=True, timeout=60, check=True)
    assert int(found.stdout.split()[-1]) < 25


def test_a_smaller_cache_gives_the_same_ids():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    small, large = tokens.tokenizer(path, 5), tokens.tokenizer(path)
    texts = ["one two three four five six seven", "", None, "six seven  eight\n nine", "déjà vu, déjà lu"]
    assert [small.encode(t) for t in texts] == [large.encode(t) for t in texts] and len(small) <= 5 < len(large)
