"""Exact spectra of integer matrices: characteristic polynomials by residues, their real roots, and null spaces.

``residues`` reduces the matrix to Hessenberg form modulo many primes at once (numpy, one array axis for the primes) and reads
the characteristic polynomial off it; ``combined`` puts the residues together by Chinese remaindering. ``largest_roots`` isolates
roots by exact bisection: a polynomial with real roots only has as many positive roots as its coefficients change sign, so the
signs of a shifted polynomial count the roots beyond any point, multiplicities included. ``null_vectors`` solves against
``matrix - root`` in decimal arithmetic of ``DIGITS`` digits.
"""

from __future__ import annotations

from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np

# A root is known to this many bits beyond its leading one; solving uses so many digits.
BITS = 220
DIGITS = 160


def _is_prime(n: int) -> bool:
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # enough below 3,215,031,751
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes from 2**31 downwards whose product is over twice the bound."""
    out, product, n = [], 1, (1 << 31) - 1
    while product <= 2 * bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient is larger: a principal minor of a semidefinite matrix is at most the product of its diagonal."""
    bound = 1
    for i, row in enumerate(matrix):
        bound *= 1 + abs(row[i])
    return bound


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverses modulo the primes by Fermat's theorem; 0 for 0."""
    out, power, rest = np.ones_like(x), x % p, p - 2
    while rest.any():
        out = np.where(rest & 1 == 1, out * power % p, out)
        power, rest = power * power % p, rest >> 1
    return out


def residues(matrix: list[list[int]], primes: np.ndarray) -> np.ndarray:
    """Coefficients, lowest first, of det(x - matrix) modulo each prime: (primes, d + 1)."""
    d, p = len(matrix), primes.astype(np.int64)
    flat = [v for row in matrix for v in row]
    h = np.array([[v % int(q) for v in flat] for q in p], dtype=np.int64).reshape(len(p), d, d)
    each, p2, p3 = np.arange(len(p)), p[:, None], p[:, None, None]
    for k in range(1, d - 1):
        column = h[:, k:, k - 1]
        pivot = k + (column != 0).argmax(axis=1)  # of each prime: swap row and column into place
        rows = h[each, pivot].copy()
        h[each, pivot] = h[each, k]
        h[each, k] = rows
        columns = h[each, :, pivot].copy()
        h[each, :, pivot] = h[each, :, k]
        h[each, :, k] = columns
        factor = h[:, k + 1 :, k - 1] * _inverse(h[:, k, k - 1], p)[:, None] % p2
        h[:, k + 1 :, :] = (h[:, k + 1 :, :] - factor[:, :, None] * h[:, k, None, :] % p3) % p3
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1 :] * factor[:, None, :] % p3).sum(axis=2)) % p2
    polys = np.zeros((d + 1, len(p), d + 1), dtype=np.int64)
    polys[0, :, 0] = 1
    for k in range(1, d + 1):
        last = polys[k - 1]
        new = np.zeros_like(last)
        new[:, 1:] = last[:, :-1]
        new = (new - h[:, k - 1, k - 1, None] * last) % p2
        chain = np.ones(len(p), dtype=np.int64)
        for i in range(1, k):
            chain = chain * h[:, k - i, k - i - 1] % p
            new = (new - (chain * h[:, k - i - 1, k - 1] % p)[:, None] * polys[k - i - 1]) % p2
        polys[k] = new
    return polys[d]


def combined(primes: list[int], rows: list[list[int]]) -> list[int]:
    """The integers of least size with the given residues (one row for each prime)."""
    product = 1
    for q in primes:
        product *= q
    parts = []
    for q in primes:
        rest = product // q
        parts.append(rest * pow(rest, -1, q))
    out = []
    for column in zip(*rows):
        value = sum(r * part for r, part in zip(column, parts)) % product
        out.append(value - product if 2 * value > product else value)
    return out


def _beyond(poly: list[int], point: int, shift: int) -> int:
    """How many roots are larger than point / 2**shift."""
    d = len(poly) - 1
    c = [v << (shift * (d - i)) for i, v in enumerate(poly)]
    for start in range(d):  # the polynomial in (x + point), by repeated synthetic division
        for i in range(d - 1, start - 1, -1):
            c[i] += point * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], point: int, shift: int) -> int:
    value, scale = 0, 0
    for v in reversed(poly):
        value = value * point + (v << scale)
        scale += shift
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], most: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots, falling, with multiplicities, until these add up to ``most``; ``poly`` has real roots only."""
    while poly and not poly[0]:
        poly = poly[1:]  # roots of zero
    if len(poly) < 2:
        return []
    top = 1 << max(abs(poly[-2]).bit_length(), 1)  # the sum of the roots is below
    found: list[tuple[Fraction, int]] = []
    todo = [(0, top, 0, _beyond(poly, 0, 0), 0)]  # roots in (low, high], both over 2**shift; how many beyond each
    while todo and sum(m for _, m in found) < most:
        low, high, shift, above_low, above_high = todo.pop()
        count = above_low - above_high
        if not count:
            continue
        narrow = low > 0 and low.bit_length() > BITS and high - low <= 1
        if count == 1 and low > 0:
            found.append((_refined(poly, low, high, shift), 1))
        elif narrow:
            found.append((Fraction(low + high, 2 << shift), count))
        else:
            if high - low <= 1:
                low, high, shift = 2 * low, 2 * high, shift + 1
            middle = (low + high) // 2
            above = _beyond(poly, middle, shift)
            todo += [(low, middle, shift, above_low, above), (middle, high, shift, above, above_high)]
    return found


def _refined(poly: list[int], low: int, high: int, shift: int) -> Fraction:
    """The one root in (low, high] / 2**shift."""
    side = _sign(poly, high, shift)
    if not side:
        return Fraction(high, 1 << shift)
    while low.bit_length() <= BITS or high - low > 1:
        if high - low <= 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        middle = (low + high) // 2
        here = _sign(poly, middle, shift)
        if not here and middle > low:
            return Fraction(middle, 1 << shift)
        low, high = (low, middle) if here == side else (middle, high)
    return Fraction(low + high, 2 << shift)


def decimal(value: Fraction) -> Decimal:
    return Decimal(value.numerator) / Decimal(value.denominator)


def null_vectors(matrix: list[list[int]], root: Fraction, count: int) -> list[np.ndarray]:
    """Orthonormal vectors of the null space of matrix - root, by inverse iteration from fixed starts."""
    with localcontext() as context:
        context.prec = DIGITS
        d = len(matrix)
        a = np.array([[Decimal(v) for v in row] for row in matrix], dtype=object)
        value = decimal(root)
        for i in range(d):
            a[i, i] -= value
        tiny = (value or Decimal(1)).scaleb(-DIGITS)
        order = np.arange(d)
        for k in range(d):
            pivot = k + int(np.abs(a[k:, k]).argmax())
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if not a[k, k]:
                a[k, k] = tiny
            a[k + 1 :, k] /= a[k, k]
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
        found: list[np.ndarray] = []
        for t in range(count):
            y = np.array([Decimal(1 + (7 * i + 13 * t * i + 5 * t) % 31) for i in range(d)], dtype=object)
            for _ in range(3):
                y = y[order]
                for k in range(d):
                    y[k + 1 :] -= a[k + 1 :, k] * y[k]
                for k in range(d - 1, -1, -1):
                    y[k] /= a[k, k]
                    y[:k] -= a[:k, k] * y[k]
                for _ in range(2):
                    for v in found:
                        y = y - v * (v * y).sum()
                    y = y / (y * y).sum().sqrt()
            found.append(y)
    return found
