"""The prime that spreads contexts over a token file."""

from __future__ import annotations


def is_prime(n: int) -> bool:
    if n < 2:
        return False
    if n % 2 == 0:
        return n == 2
    k = 3
    while k * k <= n:
        if n % k == 0:
            return False
        k += 2
    return True


def magic_prime(total_tokens: int, context_length: int) -> int:
    """The largest prime below ``total / context - 1`` that leaves 2 when divided by 3; 0 without one or for small files."""
    if total_tokens <= 3 * context_length:
        return 0
    slot = total_tokens // context_length - 1
    return next((i for i in range(slot - 1, 1, -1) if i % 3 == 2 and is_prime(i)), 0)
