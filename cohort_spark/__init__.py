"""DataFrame operators for irregularly sampled entity / time / variable data."""
