"""Scalar kernels shared by the operators."""
