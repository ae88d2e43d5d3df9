"""End-to-end batch jobs: the processor (set tables) and the accuracy report."""
