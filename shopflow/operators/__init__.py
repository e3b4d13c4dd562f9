"""Table transformations: cleaning, gold tables, forecasting, segmentation, gating."""
