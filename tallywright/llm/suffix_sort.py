"""Suffix sorting of many short strings at once, by linear grouping.

Suffixes are grouped by their Lyndon prefix. Groups are taken in descending order; every
suffix of the group points to the nearest suffix on its left that is in a lower group, and
the suffixes pointed to move from their groups into new ones right above, in the order of
how many pointers they got. In the end the groups stand in order, and going over the
suffixes in ascending order emits, along the pointers, the next suffix of each group:
nothing is renamed or sorted again. The strings are worked on in step, so that each step
is a few array operations.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of every pair, one after the other."""
    total = int(sizes.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(total) + shift


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, offsets)``: the suffix array of each string.

    ``symbols`` holds the strings one after the other; each ends with a 0 that it has
    nowhere else. ``order[offsets[i] : offsets[i] + lengths[i]]`` are the places in
    ``symbols`` of string i's suffixes, ascending.
    """
    lengths = np.asarray(lengths, dtype=np.int64)
    count = len(lengths)
    plain = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if count else np.zeros(0, np.int64)
    # A slot before each string stands for "nothing on the left": it is below every group.
    first = plain + np.arange(1, count + 1)
    size = int(lengths.sum()) + count
    owner = np.repeat(np.arange(count), lengths)
    places = np.arange(len(symbols)) + owner + 1
    group, previous = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    at_slot, slot_of, members = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)

    order = np.lexsort((symbols, owner))
    at_slot[places] = places[order]
    slot_of[at_slot[places]] = places
    key, own = symbols[order], owner[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    heads = np.flatnonzero(new)
    widths = np.diff(np.append(heads, len(order)))
    group[at_slot[places]] = np.repeat(places[heads], widths)
    members[places[heads]] = widths

    _group_by_lyndon_prefix(first, lengths, group, previous, at_slot, slot_of, members)
    sorted_slots = _emit(first, lengths, group, previous, size)
    order = sorted_slots[places]
    return order - owner - 1, plain


def _group_by_lyndon_prefix(first, lengths, group, previous, at_slot, slot_of, members) -> None:
    end = first + lengths
    moved = np.zeros(len(group), dtype=bool)
    live = np.flatnonzero(end > first + 1)
    while len(live):
        start = group[at_slot[end[live] - 1]]
        sizes = end[live] - start
        suffixes = at_slot[_ranges(start, sizes)]
        lowest = np.repeat(start, sizes)
        left = suffixes - 1
        previous[suffixes] = left
        while True:
            high = np.flatnonzero(group[left] >= lowest)
            if not len(high):
                break
            left[high] = previous[left[high]]
            previous[suffixes[high]] = left[high]
        end[live] = start
        live = live[start > first[live] + 1]
        hit = np.sort(left[group[left] >= 0])
        if not len(hit):
            continue
        fresh = np.ones(len(hit), dtype=bool)
        fresh[1:] = hit[1:] != hit[:-1]
        at = np.flatnonzero(fresh)
        target, pointers = hit[at], np.diff(np.append(at, len(hit)))
        old = group[target]
        by = np.lexsort((pointers, old))
        target, pointers, old = target[by], pointers[by], old[by]
        # Targets move to the top slots of their group, those with more pointers higher.
        edge = np.ones(len(target), dtype=bool)
        edge[1:] = old[1:] != old[:-1]
        heads = np.flatnonzero(edge)
        widths = np.diff(np.append(heads, len(target)))
        old_start = old[heads]
        top = old_start + members[old_start] - widths
        slots = _ranges(top, widths)
        moved[target] = True
        there = at_slot[slots]
        stays = there[~moved[there]]
        held = slot_of[target]
        vacated = held[held < np.repeat(top, widths)]
        at_slot[vacated] = stays
        slot_of[stays] = vacated
        at_slot[slots] = target
        slot_of[target] = slots
        moved[target] = False
        members[old_start] -= widths
        edge[1:] |= pointers[1:] != pointers[:-1]
        heads = np.flatnonzero(edge)
        widths = np.diff(np.append(heads, len(target)))
        group[target] = np.repeat(slots[heads], widths)
        members[slots[heads]] = widths


def _emit(first, lengths, group, previous, size) -> np.ndarray:
    out = np.zeros(size, np.int64)
    free = np.arange(size)
    placed = np.zeros(size, dtype=bool)
    nothing = group < 0
    placed[nothing] = True
    last = first + lengths - 1
    out[first] = last
    placed[last] = True
    by_length = np.argsort(-lengths, kind="stable")
    ordered, sizes = first[by_length], lengths[by_length]
    live = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
    for step, n in enumerate(live):
        at = out[ordered[:n] + step] - 1
        at = at[~placed[at]]
        while len(at):
            mine = group[at]
            slot = free[mine]
            out[slot] = at
            free[mine] = slot + 1
            placed[at] = True
            at = previous[at]
            at = at[~placed[at]]
    return out
