"""What Python workers keep between tasks."""

import gc
import tracemalloc
import weakref

import numpy as np
import public_tokenizers

from lakemart.llm import minhash, nbest

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_tables_are_kept_for_the_next_task_of_an_operator():
    assert nbest.segmenter(MODEL) is nbest.segmenter(MODEL)
    assert minhash._shifted(10).base is minhash._shifted(10).base


def test_another_operator_lets_the_tables_go():
    kept = weakref.ref(nbest.segmenter(MODEL))
    assert kept() is not None
    minhash.signature(np.arange(5, dtype=np.uint64), 10)
    gc.collect()
    assert kept() is None


def test_a_batch_does_not_copy_all_that_is_remembered():
    own = nbest.Segmenter(MODEL)
    texts = ["some words to remember"]
    first = list(own.segment(texts))[0]
    more = 1 << 20
    own.scores = np.append(own.scores, np.zeros(more, np.int64))
    own.losses = np.concatenate([own.losses, np.zeros((more, own.n - 1))])
    own.ends = np.append(own.ends, np.full(more * own.width, own.ends[-1]))
    tracemalloc.start()
    again = list(own.segment(texts))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert again[1] == first[1] and again[0].tolist() == first[0].tolist()
    assert peak < 4 << 20
