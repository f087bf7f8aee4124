"""Column builders; the only Python on executors is in kernels.py."""
