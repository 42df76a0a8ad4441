"""Suffix arrays of byte strings by induced sorting, and their permuted common prefixes, in whole-array steps.

The steps are those of induced sorting: classify suffixes as smaller (S) or larger (L) than their right neighbour; name the
substrings between leftmost S places; sort the reduced string of names; induce the L suffixes from left to right and the S
suffixes from right to left, one bucket of first bytes after the other.  Inside a bucket, suffixes that induce their own
left neighbour do so in rounds, so every step handles arrays.  The reduced string has too many names for buckets; it is sorted by doubling
the span of its ranks, which touches only what is still tied.
"""

import numpy as np

_CHARS = 6  # ten bits each: byte + 1, and the type


def classify(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; `text` ends with a unique smallest character."""
    last = len(text) - 1
    place = np.arange(last, dtype=np.int32)
    # The next place whose right neighbour differs decides for a run of equal characters.
    turn = np.minimum.accumulate(np.where(text[1:] != text[:-1], place, last)[::-1])[::-1]
    return np.r_[text[turn] < text[turn + 1], True] if last else np.ones(1, bool)


def refine(order: np.ndarray, rank: np.ndarray, tied: np.ndarray, span: int, limit: int | None = None) -> None:
    """Finish `order` and `rank` in place by doubling: ties in the first `span` items are broken by the ranks further on.

    `tied` are the places in `order` whose items are not yet told apart.  Ranks are 1-based first places, 0 past the end.
    """
    while len(tied) and (limit is None or span < limit):
        who = order[tied]
        ahead = who + span
        after = np.where(ahead < len(rank), rank[np.minimum(ahead, len(rank) - 1)], 0)
        group = rank[who]
        inner = np.lexsort((after, group))
        order[tied] = who = who[inner]
        group, after = group[inner], after[inner]
        begins = np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]
        rank[who] = np.maximum.accumulate(np.where(begins, tied + 1, 0))
        tied = tied[~(begins & np.r_[begins[1:], True])]
        span *= 2


def sorted_leftmost(text: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Places of leftmost S suffixes, in suffix order."""
    places = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ends = np.r_[places[1:], places[-1:]]  # a substring runs to the next place, that one included
    code = (text.astype(np.int64) << 1 | small) + 1
    code = np.r_[code, np.zeros(_CHARS, np.int64)]

    def keys(which: np.ndarray, skip: int) -> np.ndarray:
        at, end = places[which] + skip, ends[which]
        key = np.zeros(len(which), np.int64)
        for step in range(_CHARS):
            inside = at + step <= end
            key = key << 10 | np.where(inside, code[np.minimum(at + step, len(code) - 1)], 0)
        return key

    # Names: order of the substrings' first characters, then of the following ones where they tie and go on.
    first = keys(np.arange(len(places)), 0)
    order = np.argsort(first, kind="stable")
    begins = np.r_[True, first[order][1:] != first[order][:-1]]
    rank = np.zeros(len(places), np.int64)
    rank[order] = np.maximum.accumulate(np.where(begins, np.arange(1, len(order) + 1), 0))
    tied = np.flatnonzero(~(begins & np.r_[begins[1:], True]))
    skip, open_ = _CHARS, tied
    while True:
        open_ = open_[ends[order[open_]] >= places[order[open_]] + skip]
        if not len(open_):
            break
        who = order[open_]
        more, group = keys(who, skip), rank[who]
        inner = np.lexsort((more, group))
        order[open_] = who = who[inner]
        group, more = group[inner], more[inner]
        fresh = np.r_[True, (group[1:] != group[:-1]) | (more[1:] != more[:-1])]
        rank[who] = np.maximum.accumulate(np.where(fresh, open_ + 1, 0))
        open_ = open_[~(fresh & np.r_[fresh[1:], True])]
        skip += _CHARS
    # The reduced string of names.
    sorted_rank = rank[order]
    same = sorted_rank[1:] == sorted_rank[:-1]
    tied = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
    refine(order, rank, tied, 1)
    return places[order]


def induce(text: np.ndarray, small: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The suffix array, from the sorted leftmost S suffixes."""
    letters = int(text.max()) + 1
    counts = np.bincount(text, minlength=letters)
    ends = np.cumsum(counts)
    starts = ends - counts
    array = np.full(len(text), -1, np.int32)
    seeds = np.bincount(text[leftmost], minlength=letters)
    seeded = ends - seeds
    array[np.arange(len(leftmost)) + np.repeat(seeded - (np.cumsum(seeds) - seeds), seeds)] = leftmost

    def neighbours(block: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left neighbours of one type, by their first character, with the count and rank of each."""
        left = block[block > 0] - 1
        left = left[small[left] == kind]
        first = text[left]
        order = np.argsort(first, kind="stable")
        number = np.bincount(first, minlength=letters)
        return left[order], number, np.arange(len(left)) - np.repeat(np.cumsum(number) - number, number)

    heads = starts.copy()
    for letter in np.flatnonzero(counts).tolist():
        done = int(starts[letter])
        while done < heads[letter]:
            begin, done = done, int(heads[letter])
            left, number, place = neighbours(array[begin:done], False)
            array[np.repeat(heads, number) + place] = left
            heads += number
        if seeds[letter]:
            left, number, place = neighbours(array[seeded[letter] : ends[letter]], False)
            array[np.repeat(heads, number) + place] = left
            heads += number
    # heads now close the L part of each bucket; the S part is filled anew from the right.
    tails = ends.copy()
    array[0], tails[text[-1]] = len(text) - 1, 0 if counts[text[-1]] == 1 else tails[text[-1]]
    for letter in np.flatnonzero(counts).tolist()[::-1]:
        done = int(ends[letter])
        while done > tails[letter]:
            begin, done = done, int(tails[letter])
            left, number, place = neighbours(array[done:begin][::-1], True)
            array[np.repeat(tails, number) - 1 - place] = left
            tails -= number
        left, number, place = neighbours(array[starts[letter] : heads[letter]][::-1], True)
        array[np.repeat(tails, number) - 1 - place] = left
        tails -= number
    return array


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffix array of bytes, without the end mark."""
    if not len(data):
        return np.zeros(0, np.int32)
    text = np.r_[data.astype(np.int16) + 1, np.zeros(1, np.int16)]
    small = classify(text)
    return induce(text, small, sorted_leftmost(text, small))[1:]


def common_prefixes(data: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with its predecessor in the array, by place in the text.

    A value is one less than that of the place before if both suffixes follow the same byte; the others are compared.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    place = np.arange(n)
    fresh = (before < 0) | (before == 0) | (place == 0)
    fresh[~fresh] = data[place[~fresh] - 1] != data[before[~fresh] - 1]
    starts = np.flatnonzero(fresh)
    length = np.zeros(n, np.int64)
    padded = np.r_[data, np.zeros(16 - n % 8, np.uint8)]
    words = np.ascontiguousarray(np.lib.stride_tricks.as_strided(padded.view("<u8")[:1], (n + 1,), (1,)))
    open_ = starts[before[starts] >= 0]
    one = np.uint64(1)
    while len(open_):
        a, b = open_ + length[open_], before[open_] + length[open_]
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        equal = np.bitwise_count((differ & (~differ + one)) - one) >> 3  # bytes below the lowest bit that differs
        run = np.minimum(equal.astype(np.int64), n - np.maximum(a, b))
        length[open_] += run
        open_ = open_[run == 8]
    from_ = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.maximum(length[from_] - (place - from_), 0)
