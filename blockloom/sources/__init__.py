"""Reading parsed blocks, chain events and chain metadata."""
