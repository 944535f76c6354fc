"""Dataset plans, layer by layer, and the questions asked of them."""
