"""Brute force that several tests share."""


def smallest_reachable(n, linked):
    """The smallest index each of ``n`` items reaches over ``linked(i)``, the later items it links to."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in linked(i):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
