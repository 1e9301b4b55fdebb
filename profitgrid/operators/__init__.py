"""Building blocks: ledger sums, weights, allocation, balances at risk, reshaping, dimensions."""
