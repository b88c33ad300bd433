"""Multi-step jobs: feature assembly, forecasters, the batch forecast."""
