"""Sequential kernels over single sequences: plain Python and numpy, called from Arrow-batched functions."""
