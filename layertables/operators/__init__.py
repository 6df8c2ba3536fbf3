"""DataFrame → DataFrame operators. None of them runs an action, except the
sampled search for hot keys of inputs above a gigabyte."""
