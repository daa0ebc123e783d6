"""Stand-ins for embedding models and remote clients."""

import numpy as np


class Lengths:
    dim = 4

    def __init__(self):
        self.calls = []

    def encode(self, texts):
        self.calls.append(list(texts))
        return [[len(t) + i for i in range(self.dim)] for t in texts]


class Seeded:
    dim = 8

    def encode(self, texts):
        return np.random.default_rng(0).normal(size=(len(texts), self.dim))


class Busy(Exception):
    pass


class Failing(Lengths):
    def __init__(self, times, error=Busy):
        super().__init__()
        self.left, self.error = times, error

    def encode(self, texts):
        if self.left:
            self.left -= 1
            raise self.error()
        return super().encode(texts)
