"""Building lattices: what a step of the filter holds, and look-ups whose place is taken."""

import tracemalloc

import numpy as np
import public_tokenizers

from ebbline.llm import pieces
from ebbline.llm.queries import PIECES


def test_a_filter_step_gathers_by_slices():
    v = pieces.vocabulary(public_tokenizers.path(PIECES))
    lattices = pieces.Lattices([f" {i:06d}abcdefghijkl" for i in range(3_000)], v)
    weight = np.ones((len(lattices.piece), v.longest), np.float32)
    tracemalloc.start()
    lattices._filter(weight)
    peak = tracemalloc.get_traced_memory()[1] - lattices.cum.nbytes - 8 * len(weight)
    tracemalloc.stop()
    # Its own sums and the last step's; a table of rows to gather would be as large again.
    assert peak < 2.6 * 8 * 3_000 * v.longest


def test_strings_that_share_a_place_are_found():
    v = pieces.vocabulary(public_tokenizers.path(PIECES))
    slots = np.flatnonzero(v.hashes)
    moved = slots[(v.hashes[slots] >> np.uint64(64 - pieces._SLOTS)).astype(np.int64) != slots]
    assert len(moved) and (v.lookup(v.hashes[slots]) == v.found[slots]).all()
    unknown = v.hashes[moved] ^ np.uint64(1)
    assert (v.lookup(unknown) == -2).all()
