"""shopflow: a shop-sales lakehouse written as plain DataFrame -> DataFrame functions."""
